"""Documents that survive their input, and the continuous job: like the batch function, after restarts and replays, with a poisoned document."""

import datetime
import glob
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from lingualake.functions import text, urls
from lingualake.operators import documents as D
from lingualake.operators import sync as S
from lingualake.sources.sinks import document_store
from lingualake.streaming import changes as C

TM = "source_locale string, target_locale string, src string, tgt string"
CHANGES = "job_id long, entity_type string, slug string, doc_id long, locale string, operation string, status string, is_auto boolean, ts timestamp, data string"
T0 = datetime.datetime(2024, 1, 1)
WORDS = ["Cold air", "Warm air", "Hello you", "Deep text here", "About us"]


def memory(spark):
    return spark.createDataFrame([("en", lo, w, f"{w} ({lo})") for lo in ("es", "fr") for w in WORDS], TM)


def test_repeated_ids_and_malformed_documents(spark):
    deep = '{"title":"Cold air","a":' + "[" * 3000 + '{"title":"Warm air"}' + "]" * 3000 + "}"
    rows = [(1, '{"title":"Cold air","id":"a_fr"}'), (1, '{"title":"Cold air","id":"a_fr"}'), (1, '{"title":"Warm air","text":"Cold air"}'), (2, "{bad"), (3, None), (None, '{"title":"Hello you"}'), (4, deep), (5, "[" * 200_000)]
    got = D.translate_documents(spark.createDataFrame(rows, "doc_id long, doc string"), memory(spark), ["es"]).collect()
    assert len(got) == len(rows)
    docs = sorted((json.loads(r["doc"])["title"], r["doc_id"]) for r in got if r["doc"] and r["doc_id"] not in (4, None))
    assert docs == [("Cold air (es)", 1), ("Cold air (es)", 1), ("Warm air (es)", 1)]
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (1,)}
    assert by[2]["doc"] is None and by[2]["error"].startswith("JSONDecodeError") and by[3]["error"] is None and by[3]["doc"] is None
    assert "Warm air (es)" in by[4]["doc"] and by[5]["error"].startswith("RecursionError")


def test_helpers_give_null_for_malformed_rows(spark):
    df = spark.createDataFrame([("{bad", "[1"), ('{"title":""}', '{"title":"mine"}')], "a string, b string")
    got = df.select(D.merge_documents("a", "b").alias("m"), D.stripped("a").alias("s"), D.richtext_strings("a").alias("r"), D.jsonld_strings("a").alias("j"), D.localized("a", F.lit("es")).alias("l"), D.apply_richtext("a", "b").alias("p")).collect()
    assert set(got[0]) == {None} and json.loads(got[1]["m"]) == {"title": "mine"}


def test_lists_of_lists_merge_by_position():
    assert D.merge_values({"rows": [[{"title": "neu"}], ["x"]]}, {"rows": [[{"title": "mine"}]]}) == {"rows": [[{"title": "mine"}], ["x"]]}


def test_jsonld_keeps_what_is_not_to_change(spark):
    node = {"@type": "WebPage", "about": {"@type": "Article", "name": "Air"}, "name": {"@type": "WebPage"}, "part": {"@graph": [{"@type": "Article", "url": "https://a.com/x?q=1"}], "note": 1}}
    out = D.localized_jsonld(json.loads(json.dumps(node)), {"Air": "Aire"}, {"https://a.com/x?q=1": "https://a.com/es/x"}, "es")
    assert out == {"@type": "WebPage", "about": {"@type": "Article", "name": "Air"}, "name": {"@type": "WebPage"}, "part": {"@context": "https://schema.org", "@graph": [{"@type": "Article", "url": "https://a.com/es/x", "inLanguage": "es"}]}, "inLanguage": "es"}
    pages = spark.createDataFrame([(1, '{"name":"Cold air","url":"https://a.com/p","slogan":"Warm air"}', None), (1, '{"name":"Cold air"}', ""), (2, "{", None), (3, None, None), (4, "{}", '{"kept":1}')], "page_id long, schema string, existing string")
    got = D.localize_jsonld(pages, memory(spark), "es", "https://a.com", path_hook=lambda path, lo: F.concat(F.lit("/x/"), lo, path), exact=["Warm air"]).collect()
    assert sorted(str(r["schema"]) for r in got if r["page_id"] == 1) == ['{"name": "Cold air (es)", "url": "https://a.com/x/es/p", "slogan": "Warm air"}', '{"name": "Cold air (es)"}']
    assert {r["page_id"]: (r["schema"], (r["error"] or "")[:4]) for r in got if r["page_id"] > 1} == {2: (None, "JSON"), 3: (None, ""), 4: ('{"kept":1}', "")}


def test_hooks_are_columns_or_pandas_functions(spark):
    @F.pandas_udf("string")
    def loud(title: pd.Series, locale: pd.Series, slug: pd.Series) -> pd.Series:
        return title.str.upper() + "-" + locale

    df = spark.createDataFrame([("About us", "about", "https://a.com/de/b#f")], "t string, s string, u string")
    one = df.select(
        text.localized_slug(F.lit(None), F.col("s"), [F.col("t")], "es", hook=loud).alias("a"),
        text.localized_slug(F.lit(None), F.col("s"), [F.col("t")], "es", hook=lambda t, lo, s: F.concat(s, F.lit("-"), lo)).alias("b"),
        text.localized_slug(F.lit(None), F.col("s"), [F.col("t")], "es", hook=lambda t, lo, s: F.lit("")).alias("c"),
        text.localized_slug(F.lit(None), F.col("s"), [F.col("t")], "es").alias("d"),
        urls.localize_url(F.col("u"), F.lit("es"), F.lit("https://a.com"), lambda p, lo: F.concat(p, F.lit("/"), lo)).alias("e"),
        urls.localize_url(F.col("u"), F.lit("es"), F.lit("https://a.com")).alias("f"),
    ).collect()[0]
    assert tuple(one) == ("ABOUT US-es", "about-es", "about", "about-us", "https://a.com/de/b/es#f", "https://a.com/es/b#f")


def test_a_change_in_every_locale(spark):
    doc = {"id": 7, "title": "Cold air", "slug": "cold-air", "_status": "draft", "createdAt": "x", "meta": {"title": "Hello you", "schema": {"@type": "WebPage", "name": "Deep text here", "url": "https://a.com/cold-air"}, "overrideDefaultSchema": 1}, "rows": [{"id": "r1", "title": "Warm air"}, {"id": 3, "title": "About us"}]}
    old = {"es": {"title": "mío", "slug": "cold-air", "rows": [{"id": "r1_es", "title": ""}], "meta": {"schema": {"name": "own"}}}, "fr": "{broken", "de": {"slug": "kalt"}}
    changes = spark.createDataFrame([("k", "collection", "pages", T0, "draft", json.dumps(doc)), ("g", "global", "pages", T0, None, '{"title":"Cold air","slug":"cold-air"}'), ("bad", "collection", "pages", T0, None, "[1]")], "key string, entity_type string, slug string, ts timestamp, status string, data string")
    existing = spark.createDataFrame([("k", lo, v if isinstance(v, str) else json.dumps(v)) for lo, v in old.items()], "key string, locale string, doc string")
    options = S.SyncOptions(("es", "fr", "de", "ar"), slugs={"pages"}, schema=True, site="https://a.com", exact=("About us",))
    got = {(r["key"], r["locale"]): r for r in S.synced(changes, existing, memory(spark), options).collect()}
    assert len(got) == 12
    assert json.loads(got["k", "es"]["doc"]) == {"title": "mío", "slug": "cold-air-es", "meta": {"title": "Hello you (es)", "schema": {"name": "own"}, "overrideDefaultSchema": True}, "rows": [{"id": "r1_es", "title": "Warm air (es)"}, {"title": "About us"}]}
    assert got["k", "es"]["draft"] and got["k", "fr"]["doc"] is None and got["k", "fr"]["error"].startswith("JSONDecodeError")
    german = json.loads(got["k", "de"]["doc"])
    assert german["slug"] == "kalt" and german["meta"]["schema"] == {"@type": "WebPage", "name": "Deep text here", "url": "https://a.com/de/cold-air", "inLanguage": "de"}
    assert json.loads(got["k", "ar"]["doc"])["slug"] == "cold-air"
    assert json.loads(got["g", "es"]["doc"]) == {"title": "Cold air (es)", "slug": "cold-air"}
    assert all(got["bad", lo]["error"] == "ValueError: the document is no object" for lo in options.locales)


def test_strings_that_the_memory_lacks_go_to_the_translator(spark):
    changes = spark.createDataFrame([("k", "global", "x", T0, None, '{"title":"Cold air","text":"Never seen this"}')], "key string, entity_type string, slug string, ts timestamp, status string, data string")
    none = spark.createDataFrame([], "key string, locale string, doc string")
    got = S.synced(changes, none, memory(spark), S.SyncOptions(("es",)), call=lambda batch, lo: [f"<{x}>" for x in batch]).collect()
    assert json.loads(got[0]["doc"]) == {"title": "Cold air (es)", "text": "<Never seen this>"}


def stream_rows():
    """Three files of changes: documents changed within a second of quiet, one of them poisoned, then a late one that ends the sessions."""

    def row(job, doc_id, second, data):
        return (job, "collection", "pages", doc_id, "en", "update", "published", False, T0 + datetime.timedelta(seconds=second), data)

    first = [row(1, 1, 0, '{"title":"Old title"}'), row(2, 1, 0.5, '{"title":"Cold air","id":"d1"}'), row(3, 2, 0, "{poison"), row(4, 3, 0, '{"title":"Hello you"}')]
    second = [row(5, 4, 60, '{"title":"Warm air"}'), row(6, 5, 60, '{"title":"Deep text here","rows":[{"id":"x_en","title":"About us"}]}')]
    return [first, second, [row(7, 99, 3600, '{"title":"Cold air"}')]]


def test_the_stream_ends_like_the_batch(spark, tmp_path):
    options, batches = S.SyncOptions(("es", "fr")), stream_rows()
    path, inbox = str(tmp_path / "job"), tmp_path / "in"
    existing = spark.createDataFrame([("collection:pages:3", "fr", '{"title":"mon titre"}')], "key string, locale string, doc string")
    store = document_store(spark, str(tmp_path / "store"), 4, existing)

    def run():
        C.continuous_sync(C.read_changes(spark, str(inbox), files=1), store, memory(spark), options, path, "2 seconds").awaitTermination()

    def rows(df):
        return {(r["key"], r["locale"], json.dumps(json.loads(r["doc"]), sort_keys=True)) for r in df.where("doc IS NOT NULL").collect()}

    for k, batch in enumerate(batches):  # a run a file, so each starts where the last ended
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(str(inbox))
        run()
    emitted = spark.createDataFrame([r for b in batches[:2] for r in b], CHANGES)
    want = rows(C.synced_documents(emitted, existing, memory(spark), ["es", "fr"]))
    assert rows(store.read()) == want and len(want) == 8
    assert ("collection:pages:3", "fr", '{"title": "mon titre"}') in want
    failed = spark.read.parquet(f"{path}/failed")
    assert sorted((r["key"], r["locale"], r["data"]) for r in failed.collect()) == [("collection:pages:2", lo, "{poison") for lo in ("es", "fr")]
    stats = C.sync_stats(spark, path).collect()[0]
    assert (stats["changes"], stats["completed"], stats["failed"]) == (6, 8, 2) and stats["last_error"].startswith("JSONDecodeError")
    run()  # nothing new
    last = max(glob.glob(f"{path}/checkpoint/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for f in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):  # as if the last epoch had not been noted as done
        os.path.exists(f) and os.unlink(f)
    run()
    assert rows(store.read()) == want and C.sync_stats(spark, path).collect()[0] == stats
    store.compact()
    assert rows(store.read()) == want
