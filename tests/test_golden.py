"""Literal cases of merges, ids, slugs, value rules, rich text, JSON-LD and streaming."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from lingualake.functions import filters, keys, text, urls
from lingualake.operators import backfill as B
from lingualake.operators import documents as D
from lingualake.operators import seo, strings
from lingualake.streaming import changes as C


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first()["x"]


def test_merge_fills_only_what_is_empty():
    new = {"title": "Hola", "sections": [{"id": "h_1", "blockType": "hero", "headline": "Uno"}, {"id": "c_2", "blockType": "cta", "headline": "Dos"}]}
    old = {"title": "Mi titulo", "sections": [{"id": "c_2_es", "blockType": "cta", "headline": ""}, {"id": "h_1_es_fr", "blockType": "hero", "headline": "Humano"}]}
    got = D.merge_values(new, old)
    assert got["title"] == "Mi titulo"
    assert [x["headline"] for x in got["sections"]] == ["Humano", "Dos"]
    assert [x["id"] for x in got["sections"]] == ["h_1", "c_2"]


def test_merge_appends_new_blocks_and_matches_types():
    got = D.merge_blocks([{"blockType": "a", "t": "1"}, {"blockType": "b", "t": "2"}, {"blockType": "a", "t": "3"}], [{"blockType": "b", "t": "x"}, {"blockType": "a", "t": "y"}])
    assert [x["t"] for x in got] == ["y", "x", "3"]
    assert D.merge_blocks(["a"], ["b"]) == ["b"] and D.merge_blocks([], [1]) == [1]


@pytest.mark.parametrize("value,skip", [("", True), ("  ", True), ("/x", True), ("https://a.b", True), ("Centered", True), ("12 %", True), ("a@b.co", True), ("photo 3.png", True), ("#fff", True), ("507f1f77bcf86cd799439011", True), ("Hello world", False), (None, True)])
def test_values(spark, value, skip):
    assert one(spark, filters.should_skip_value(F.col("v").cast("string")), v=value) is skip


@pytest.mark.parametrize("value,locale,latin,slug", [("Über Größe!", "de", True, "ueber-groesse"), ("Ça va, señor?", "fr", True, "ca-va-senor"), ("Привет мир", "ru", True, ""), ("Привет мир", "ru", False, "привет-мир"), ("a-" * 80, "en", True, ("a-" * 60)[:-1])])
def test_slugs(spark, value, locale, latin, slug):
    assert one(spark, text.slugify(F.col("v"), locale, latin), v=value) == slug


def test_ids(spark):
    assert one(spark, keys.localize_id(F.col("v"), F.lit("es")), v="hero_1_es_fr_pt-BR") == "hero_1_es"
    assert one(spark, keys.localize_id(keys.localize_id(F.col("v"), F.lit("es")), F.lit("es")), v="hero_1") == "hero_1_es"


def test_urls(spark):
    site = "https://www.example.com"
    for url, want in ((f"{site}/en/about?x=1#top", f"{site}/es/about#top"), (f"{site}/", f"{site}/es"), (f"{site}/#Logo", f"{site}/#Logo"), (f"{site}/images/a", f"{site}/images/a"), ("https://www.example.com.evil/a", "https://www.example.com.evil/a")):
        assert one(spark, urls.localize_url(F.col("u"), F.lit("es"), F.lit(site)), u=url) == want
    assert one(spark, urls.localize_path(F.col("u"), F.lit("es")), u="/a-propos/") == "/es/sobre-nosotros"
    assert one(spark, urls.localize_path(F.col("u"), F.lit("en")), u="/soluciones/x") == "/solutions/x"
    assert one(spark, urls.contact_link(F.col("u")), u=" correo a: n@x.com ") == "mailto:n@x.com"


def test_entities_numeric(spark):
    assert one(spark, text.decode_entities(F.col("u")), u="&amp;lt; &#65;&#x1F600;") == "< A😀"


def test_richtext_and_jsonld(spark):
    doc = json.dumps({"root": {"type": "root", "children": [{"type": "text", "text": "Hello"}, {"type": "p", "children": [{"type": "text", "text": "you"}]}]}})
    assert one(spark, D.richtext_strings("d"), d=doc) == ["Hello", "you"]
    out = json.loads(one(spark, D.apply_richtext("d", "m"), d=doc, m='{"Hello": "Hola"}'))
    assert out["root"]["children"][0]["text"] == "Hola" and out["root"]["children"][1]["children"][0]["text"] == "you"
    graph = {"@graph": [{"@type": "Organization", "name": "Acme", "slogan": "We cool"}, {"@type": ["WebPage"], "name": "Home", "about": ["Air", {"description": "Deep"}]}]}
    assert D.jsonld_texts(graph) == ["We cool", "Home", "Air", "Deep"]


def test_translator_keeps_what_fails(spark):
    def call(batch, locale):
        if "bad" in batch:
            raise ValueError
        return [x.upper() for x in batch]

    rows = spark.createDataFrame([("es", x) for x in ("a", "bad", "c")], "locale string, src string").coalesce(1)
    got = {r["src"]: (r["tgt"], r["failed"]) for r in strings.translate(rows, call).collect()}
    assert got == {"a": ("A", False), "bad": ("bad", True), "c": ("C", False)}


def test_backfill_twice_changes_nothing_new(spark):
    table = spark.createDataFrame([("p1", "en", 1, "red tea"), ("p2", "en", 2, "blue tea"), ("p1_es", "es", 1, "")], "id string, _locale string, _parent_id long, title string")
    tm = spark.createDataFrame([("en", "es", "red tea", "té rojo"), ("en", "es", "blue tea", "té azul")], "source_locale string, target_locale string, src string, tgt string")
    for k in range(2):
        m = B.with_needs(B.match_target_rows(table, ["es"], ["title"]), ["title"])
        ins = B.build_inserts(m, tm, ["title"])
        new = B.apply_changes(table, B.build_updates(m, tm, ["title"]), ins, ["title"])
        if k:
            assert B.dry_run_plan(m).where("op <> 'keep'").count() == 0
        table = spark.createDataFrame(new.collect(), table.schema)
    assert {r["id"]: r["title"] for r in table.collect() if r["_locale"] == "es"} == {"p1_es": "té rojo", "p2_es": "té azul"}


def test_inserts_take_over_other_columns(spark):
    table = spark.createDataFrame([("p1", "en", 1, "red tea", 3, "a.png"), ("p2", "en", 2, "blue tea", None, None), ("p1_es", "es", 1, "", 9, "b.png")], "id string, _locale string, _parent_id long, title string, rank int, image string")
    tm = spark.createDataFrame([("en", "es", "blue tea", "té azul")], "source_locale string, target_locale string, src string, tgt string")
    m = B.with_needs(B.match_target_rows(table, ["es", "fr"], ["title"], others=["rank", "image"]), ["title"])
    new = B.apply_changes(table, B.build_updates(m, tm, ["title"]), B.build_inserts(m, tm, ["title"], others=["rank", "image"]), ["title"])
    got = {r["id"]: (r["title"], r["rank"], r["image"]) for r in new.collect() if r["_locale"] != "en"}
    assert got == {"p1_es": ("red tea", 9, "b.png"), "p2_es": ("té azul", None, None), "p1_fr": ("red tea", 3, "a.png"), "p2_fr": ("blue tea", None, None)}


def test_redirect_chains_and_circles(spark):
    rng = random.Random(4)
    edges = [(f"c{i}", f"c{i + 1}") for i in range(37)] + [("x", "x"), ("y", None), ("z", "y"), ("c3", "c4"), ("c5", "a0")]
    edges += [(f"n{rng.randrange(25)}", f"n{rng.randrange(30)}") for _ in range(40)]
    hop = {}
    for a, b in edges:
        if b is not None:
            hop[a] = max(b, hop.get(a, b))

    def end(a, at):
        seen = {a}
        while hop.get(at, a) not in seen:
            at = hop[at]
            seen.add(at)
        return at

    got = seo.flatten_redirects(spark.createDataFrame(edges, "from_path string, to_path string")).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((a, end(a, b)) for a, b in edges)
    assert seo.flatten_redirects(spark.createDataFrame([], "from_path string, to_path string")).count() == 0


def test_a_large_circle_needs_few_rounds(spark, monkeypatch):
    n, rounds = 100_000, []
    real = seo.settled
    monkeypatch.setattr(seo, "settled", lambda df: rounds.append(1) or real(df))
    ring = spark.range(n).select(F.concat(F.lit("r"), F.col("id")).alias("from_path"), F.concat(F.lit("r"), (F.col("id") + 1) % n).alias("to_path"))
    tail = spark.range(5000).select(F.concat(F.lit("t"), F.col("id")).alias("from_path"), F.when(F.col("id") == 0, "r77").otherwise(F.concat(F.lit("t"), F.col("id") - 1)).alias("to_path"))
    got = {r["from_path"]: r["to_path"] for r in seo.flatten_redirects(ring.unionByName(tail)).collect()}
    assert len(got) == n + 5000 and len(rounds) < 60
    assert all(got[f"r{i}"] == f"r{(i - 1) % n}" for i in range(n)) and {got[f"t{i}"] for i in range(1, 5000)} == {"r76"} and got["t0"] == "r77"


def test_random_redirects(spark):
    for seed in range(6):
        rng = random.Random(seed)
        edges = [(f"n{rng.randrange(14)}", f"n{rng.randrange(16)}") for _ in range(rng.randrange(5, 40))]
        hop = {}
        for a, b in edges:
            hop[a] = max(b, hop.get(a, b))

        def end(a, at):
            seen = {a}
            while at in hop and hop[at] not in seen:
                at = hop[at]
                seen.add(at)
            return at

        got = seo.flatten_redirects(spark.createDataFrame(edges, "from_path string, to_path string")).collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter((a, end(a, b)) for a, b in edges), seed


def test_stream_agrees_with_batch(spark, tmp_path):
    rows = [(i, "collection", "pages", i % 3, "en", "update", None, False, f"2024-01-01 00:{i * 7 % 60:02d}:00", None) for i in range(40)]
    df = spark.createDataFrame(rows, "job_id long, entity_type string, slug string, doc_id long, locale string, operation string, status string, is_auto boolean, ts string, data string").withColumn("ts", F.to_timestamp("ts"))
    last = df.limit(1).withColumn("ts", F.to_timestamp(F.lit("2030-01-01"))).withColumn("doc_id", F.lit(99).cast("long"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    last.write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    C.sync(C.read_changes(spark, str(tmp_path / "in")), lambda b, e: got.extend(b.collect()), str(tmp_path / "ck"), "2 minutes").awaitTermination()
    want = C.debounce(df, "2 minutes").groupBy("key").agg(F.max("ts").alias("ts")).collect()
    newest = {}
    for r in got:
        newest[r["key"]] = max(newest.get(r["key"], r["ts"]), r["ts"])
    assert {k: v for k, v in newest.items() if not k.endswith(":99")} == {r["key"]: r["ts"] for r in want}


def test_texts_of_a_row_are_looked_up_in_one_join(spark):
    rows = [("es", "Hello", "Hello", None), ("es", "Hello", "Hello", None), ("fr", "Hello", "Good day", "https://a.example"), ("es", None, None, None), ("es", "", "Unknown", "Hello"), ("es", None, "Hello", "Good day"), ("es", "Hello", None, "Good day")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)] + [(0, *rows[0])], "key long, locale string, s_a string, s_b string, s_c string").repartition(3)
    tm = spark.createDataFrame([("es", "Hello", "Hola"), ("es", "Hello", "Ah"), ("fr", "Hello", "Salut"), ("fr", "Good day", ""), ("es", "https://a.example", "no")], "target_locale string, src string, tgt string")
    want = {0: ("Hola", "Hola", None), 2: ("Salut", "Good day", "https://a.example"), 3: (None, None, None), 4: ("", "Unknown", "Hola"), 5: (None, "Hola", "Good day"), 6: ("Hola", None, "Good day")}
    for share in (None, 3):
        got = B.translated_fields(df, tm, ["a", "b", "c"], share=share)
        assert got.columns == [*df.columns, "v_a", "v_b", "v_c"]
        assert sorted((r["key"], r["v_a"], r["v_b"], r["v_c"]) for r in got.collect() if r["key"] not in (3, 4, 5, 6)) == [(0, *want[0]), (0, *want[0]), (1, *want[0]), (2, *want[2])]
        assert {r["key"]: (r["v_a"], r["v_b"], r["v_c"]) for r in got.collect() if r["key"] > 2} == {k: v for k, v in want.items() if k > 2}
    assert B.translated_fields(df.limit(0), tm, ["a", "b"]).count() == 0
