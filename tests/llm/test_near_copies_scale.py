"""The texts of a corpus stay where they are: rows are picked by bitmaps of their numbers, however many there are."""

from pyspark.sql import functions as F

from lingualake.llm import common, jaccard


def test_among(spark):
    df = spark.range(0, 100_000, 1, 5).select(F.monotonically_increasing_id().alias("rid"), "id")
    df = common.cut(df)
    ids = df.where("id % 7 IN (0, 3) OR id BETWEEN 40000 AND 41000").select("rid")
    assert sorted(r[0] for r in common.among(df, "rid", ids).select("id").collect()) == [i for i in range(100_000) if i % 7 in (0, 3) or 40_000 <= i <= 41_000]
    assert common.among(df, "rid", ids.limit(0)).count() == 0


def test_many_documents_are_not_shuffled(spark, monkeypatch):
    """beyond BROADCAST_ROWS documents the last join moved every text through the disk."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.concat(F.lit(f"w{k}"), (F.col("id") % 100).cast("string")) for k in range(12))).alias("text"))
    docs = common.cut(docs)
    want = sorted(r[0] for r in jaccard.without_near_copies(docs, 5, 80).select("doc_id").collect())
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    out = jaccard.without_near_copies(docs, 5, 80)
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in out.select("doc_id").collect()) == want == list(range(100))
