"""Writing change sets and translated documents into keyed stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import KeyedStore

#: What the store of documents holds: the newest version of each document in each locale.
DOCUMENTS = "key string, locale string, ts timestamp, draft boolean, doc string, is_auto boolean"


def write_changes(store: KeyedStore, number: int, updates: DataFrame | None = None, inserts: DataFrame | None = None) -> None:
    """One change set of a localized table: updates (keys, changed, columns) and inserts (keys, columns; not if the key is there)."""
    parts = [df.withColumn("op", F.lit(op)) for op, df in (("update", updates), ("insert", inserts)) if df is not None]
    store.put(number, parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True))


def document_store(spark: SparkSession, path: str, buckets: int = 32, existing: DataFrame | None = None) -> KeyedStore:
    """The store of translated documents at path; one that is not there yet starts with existing (key, locale, doc), or empty."""
    store = KeyedStore(spark, path, ["key", "locale"], buckets)
    if not store._sets("base"):
        rows = spark.createDataFrame([], DOCUMENTS)
        if existing is not None:
            rows = rows.unionByName(existing.select("key", "locale", "doc"), allowMissingColumns=True)
        store.create(rows)
    return store


def write_documents(store: KeyedStore, docs: DataFrame, epoch: int) -> None:
    """A micro-batch of documents (key, locale, ts, draft, doc), marked as our own writes; a replayed epoch replaces itself."""
    store.put(epoch, docs.select("key", "locale", "ts", "draft", "doc", F.lit(True).alias("is_auto"), F.lit("upsert").alias("op")))
