"""Typed documents against the JSON helpers; no Python in their plans. The database backfill with a table that fails."""

import json
import random

from pyspark.sql import functions as F

from lingualake.functions import filters, urls
from lingualake.operators import backfill as B
from lingualake.operators import database as DB
from lingualake.operators import documents as D
from lingualake.operators import typed as Y
from lingualake.sources.store import KeyedStore

DOC = "title string, slug string, n int, tags array<string>, meta struct<text:string,id:string>, rows array<struct<id:string,blockType:string,body:string,n:int,inner:array<struct<id:string,text:string>>>>"
WORDS = ["Cold air", "Warm air", "", " ", "Hello you", None, "About us"]


def document(rng):
    def block(k):
        return {"id": rng.choice([f"b{k}", f"b{k}_es", "b0", None, ""]), "blockType": rng.choice(["hero", "text", None, ""]), "body": rng.choice(WORDS), "n": rng.choice([None, 1]), "inner": rng.choice([None, [], [{"id": rng.choice(["x", "x_fr", "y"]), "text": rng.choice(WORDS)} for _ in range(rng.randrange(1, 3))]])}

    return {"title": rng.choice(WORDS), "slug": rng.choice(["a", None]), "n": rng.choice([None, 3]), "tags": rng.choice([None, [], ["Cold air", "z"]]), "meta": rng.choice([None, {"text": rng.choice(WORDS), "id": rng.choice(["m_de", None])}]), "rows": rng.choice([None, [], [block(k) for k in range(rng.randrange(1, 5))]])}


def clean(v):
    """Without nulls: a null field is one that is not there."""
    if isinstance(v, dict):
        return {k: clean(x) for k, x in v.items() if x is not None}
    return [clean(x) for x in v] if isinstance(v, list) else v


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_typed_documents_equal_the_json_helpers(spark):
    rng = random.Random(3)
    rows = [(i, document(rng), document(rng)) for i in range(120)]
    df = spark.createDataFrame(rows, f"doc_id long, doc struct<{DOC}>, old struct<{DOC}>").cache()
    kind = df.schema["doc"].dataType
    got = df.select("doc_id", Y.merged(F.col("doc"), F.col("old"), kind).alias("m"))
    no_python(got)
    for r in got.collect():
        _, new, old = rows[r["doc_id"]]
        assert clean(r["m"].asDict(True)) == clean(D.merge_values(clean(new), clean(old))), rows[r["doc_id"]]
    tm = spark.createDataFrame([("en", "es", w, f"{w} (es)") for w in WORDS if w and w.strip()], "source_locale string, target_locale string, src string, tgt string")
    docs = df.select((F.col("doc_id") % 100).alias("doc_id"), "doc")  # some ids repeat
    got = Y.translate_typed(docs, tm, ["es"])
    no_python(got)

    def by_hand(d):
        texts = {t: f"{t} (es)" for t in D.document_texts(clean(d)) if t.strip()}  # the document's own strings
        return clean(D.localized_ids(D.translated_document(clean(d), texts), "es"))

    want = sorted(json.dumps([i % 100, by_hand(d)], sort_keys=True) for i, d, _ in rows)
    assert sorted(json.dumps([r["doc_id"], clean(r["doc"].asDict(True))], sort_keys=True) for r in got.collect()) == want
    found = Y.typed_strings(df)
    assert sorted((r["doc_id"], r["src"]) for r in found.collect()) == sorted((i, t) for i, d, _ in rows for t in D.document_texts(clean(d)) if t.strip())


def test_a_table_that_fails_does_not_stop_the_others(spark, tmp_path):
    good = spark.createDataFrame([("p1", "en", 1, "red tea", 5), ("p1_fr", "fr", 1, "thé rouge", 5), ("p2", "en", 2, "blue tea", 6)], "id string, _locale string, _parent_id long, title string, n int")
    tables = {
        "good": DB.Table(good),
        "broken": DB.Table(good.drop("_parent_id")),
        "lost": DB.Table(good),
        "plain": DB.Table(good.drop("_locale")),
        "_good_v_locales": DB.Table(good),
    }
    tm = spark.createDataFrame([("en", "es", "red tea", "té rojo")], "source_locale string, target_locale string, src string, tgt string")
    calls = []

    def call(batch, locale):
        calls.append(batch)
        return [x if locale == "fr" else f"<{x}>" for x in batch]

    plan = DB.plan_backfill(tables, ["es", "fr"], tm, call=call)
    assert set(plan.matched) == {"good", "lost"} and set(plan.errors) == {"broken"}
    report = {(r["table"], r["locale"]): tuple(r)[2:] for r in DB.backfill_report(plan).collect()}
    assert report["good", "es"] == (2, 2, 0, 2, 2, 0, 0) and report["good", "fr"] == (1, 0, 1, 2, 1, 0, 1)
    store = KeyedStore(spark, str(tmp_path / "good"), ["id"], 2)
    store.create(good)
    log = {r["table"]: r for r in DB.run_backfill(plan, {"good": store}, 0, str(tmp_path / "log")).collect()}
    assert {k: (r["status"], r["updated"], r["inserted"]) for k, r in log.items()} == {"good": ("completed", 0, 3), "broken": ("failed", 0, 0), "lost": ("failed", 0, 0)}
    assert log["broken"]["error"] and log["good"]["started"] <= log["good"]["ended"]
    rows = {r["id"]: (r["title"], r["n"]) for r in store.read().collect()}
    assert rows == {"p1": ("red tea", 5), "p1_fr": ("thé rouge", 5), "p2": ("blue tea", 6), "p1_es": ("té rojo", 5), "p2_es": ("<blue tea>", 6), "p2_fr": ("blue tea", 6)}
    again = DB.plan_backfill({"good": DB.Table(store.read())}, ["es"], tm)
    assert DB.backfill_report(again).where("to_insert > 0 OR to_update > 0").count() == 0


def test_richtext_rules(spark):
    def rich(*texts, **more):
        return json.dumps({"root": {"type": "root", "children": [{"type": "text", "text": t} for t in texts], **more}})

    long = "a long enough sentence here"
    cases = {"a": (rich("Hello", " "), None, True, True), "b": (rich("https://x.y"), None, False, True), "c": (rich(long), rich(long, "x"), True, True), "d": (rich("short"), rich("short", "x"), False, False), "e": (rich("Hello"), "[1]", True, True), "f": ('{"a": 1}', None, False, True), "g": (None, rich("x"), False, False), "h": ("{bad", None, False, True), "i": (rich(long), rich("ein langer übersetzter Satz"), False, False), "j": ("null", None, False, False)}
    table = spark.createDataFrame([row for k, (s, t, *_) in cases.items() for row in ((k, "en", 1, s), (f"{k}_es", "es", 1, t))], "id string, _locale string, _parent_id long, body string")
    m = B.with_needs(B.match_target_rows(table, ["es"], ["body"], rich=["body"]), ["body"], ["body"])
    assert {r["key"]: (r["n_body"], r["w_body"]) for r in m.collect()} == {k: tuple(v[2:]) for k, v in cases.items()}
    tm = spark.createDataFrame([("en", "es", "Hello", "Hola"), ("en", "es", long, "una frase")], "source_locale string, target_locale string, src string, tgt string")
    got = {r["id"]: r["body"] for r in B.update_rows(m, tm, ["body"], ["body"]).collect()}
    assert set(got) == {"a_es", "b_es", "c_es", "e_es", "f_es", "h_es"}
    assert json.loads(got["a_es"]) == json.loads(rich("Hola", " ")) and json.loads(got["c_es"]) == json.loads(rich("una frase"))
    assert got["f_es"] == '{"a": 1}' and got["h_es"] == "{bad"


def test_heavy_strings_take_their_own_way(spark):
    from lingualake.operators.strings import heavy_strings, tm_lookup

    rows = [(i, "es", "menu" if i % 3 else f"w{i}") for i in range(300)] + [(900, "es", None), (901, "fr", "menu")]
    df = spark.createDataFrame(rows, "id long, locale string, src string")
    tm = spark.createDataFrame([("es", "menu", "menú"), ("es", "menu", "menu!"), ("es", "w3", "drei"), ("es", "w6", "")], "target_locale string, src string, tgt string")
    assert [tuple(r) for r in heavy_strings(df, "src", "locale", 10).collect()] == [("es", "menu")]
    want = sorted(map(tuple, tm_lookup(df, tm, "src", "locale").collect()), key=str)
    assert sorted(map(tuple, tm_lookup(df, tm, "src", "locale", share=10).collect()), key=str) == want and len(want) == 302


def test_patterns_are_the_jvms(spark):
    df = spark.createDataFrame([("a brand",), ("[[a]",)], "v string")
    bad = [r"(?P<x>a)", "a(?#c)", "(", r"[[a]"]
    assert [r[0] for r in df.select(filters.skip_reason(F.col("v"), patterns=[*bad, r"/^A b/i"])).collect()] == ["custom_pattern", None]


def test_a_slug_that_names_two_sections(spark):
    pages = spark.createDataFrame([("b", "en", "b"), ("a", "en", "a"), ("a", "es", "b"), ("b", "es", "be"), ("a", "es", "b")], "key string, locale string, slug string")
    items = spark.createDataFrame([], "section string, key string, locale string, slug string")
    df = spark.createDataFrame([("/b", "es"), ("b/x/", "es"), ("/", "es"), ("", "es"), (None, "en"), ("//cdn/x", "es"), ("/a", "en"), ("/", "en")], "path string, lo string")
    got = {(r["path"], r["lo"]): r["localized"] for r in urls.localized_paths(df, "path", "lo", pages, items).collect()}
    assert got == {("/b", "es"): "/es/be", ("b/x/", "es"): "/es/b/x", ("/", "es"): "/es", ("", "es"): "", (None, "en"): None, ("//cdn/x", "es"): "//cdn/x", ("/a", "en"): "/a", ("/", "en"): "/"}
