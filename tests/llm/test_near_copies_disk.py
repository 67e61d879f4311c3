"""The near copies' disk: texts are not copied, and what is shuffled goes in rounds."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lingualake.llm import common, jaccard


def _docs(spark, path):
    """Families of near copies with a word of their own, exact copies, texts without words."""
    words = [F.concat(F.lit(f"w{k}x"), (F.col("id") % 20).cast("string")) for k in range(60)]
    text = F.concat_ws(" ", *words, F.when(F.col("id") % 3 > 0, F.concat(F.lit("own"), "id")))
    docs = spark.range(0, 300, 1, 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 != 7, text).alias("text"))
    docs.write.parquet(path)
    return spark.read.parquet(path)


def test_texts_are_not_copied(spark, tmp_path, monkeypatch):
    """two copies of all texts were written in stage 2 of the pipeline."""
    docs = _docs(spark, f"{tmp_path}/documents.parquet")
    written, cut = [], common.cut
    for m in (common, jaccard):
        monkeypatch.setattr(m, "cut", lambda df, keep=False: written.append(df.columns) or cut(df, keep))
    kept = sorted(r[0] for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).select("doc_id").collect())
    assert kept == sorted([*(i for i in range(20) if i != 7), 27, *range(7, 300, 50)])
    assert written and not any("text" in columns for columns in written)
    here = docs.select("doc_id", "text")
    assert sorted(map(str, jaccard.jaccard_components(here, 5, 80, stored=True).collect())) == sorted(map(str, jaccard.jaccard_components(here, 5, 80).collect()))


def test_numbers_are_places(spark, tmp_path):
    """rows of files are told apart without a copy; rows that come from no file are written."""
    docs = _docs(spark, f"{tmp_path}/documents.parquet")
    number = common.numbered(docs, "n", stored=True)
    rows = [(r["n"], r["doc_id"]) for r in number.collect()]
    assert len({n for n, _ in rows}) == 300 and sorted(n % (1 << 33) for n, _ in rows) == sorted([*range(100)] * 3)
    assert sorted((r["n"], r["doc_id"]) for r in number.repartition(7).where("doc_id > 50").collect()) == sorted(r for r in rows if r[1] > 50)
    made = common.numbered(spark.range(10), "n", stored=True)
    assert made.columns == ["id", "n"] and len({r["n"] for r in made.collect()}) == 10


@pytest.mark.parametrize("block", [2048, 7])
def test_rounds(spark, tmp_path, monkeypatch, block):
    """all elements, all tiles and all families' texts were on disk at once; tiles in blocks grew with the square of their rows."""
    docs = _docs(spark, f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(jaccard, "BLOCK", block)
    want = sorted(map(str, jaccard.jaccard_components(docs, 5, 80).collect()))
    seen = {}
    for name in ("_prefixes", "_tiles"):
        was = getattr(jaccard, name)
        monkeypatch.setattr(jaccard, name, lambda *x, was=was, name=name: seen.setdefault(name, []).append(x[-2:]) or was(*x))
    for name, most in (("ROUND_PREFIXES", 1500), ("ROUND_TILES", 1000), ("ROUND_ELEMENTS", 4000)):
        monkeypatch.setattr(jaccard, name, most, raising=False)
    assert sorted(map(str, jaccard.jaccard_components(docs, 5, 80).collect())) == want
    assert all(len(x) > 1 and x[1] == (x[0][0], 1) for x in seen.values()) and len(seen) == 2
