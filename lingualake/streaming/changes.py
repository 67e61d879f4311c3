"""Document changes: admission, debouncing, newest job, continuous sync. Batch and stream use the same expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sync import SyncOptions, synced
from ..sources.sinks import write_documents
from ..sources.store import KeyedStore
from ..sources.tables import settled

CHANGE = "job_id long, entity_type string, slug string, doc_id long, locale string, operation string, status string, is_auto boolean, ts timestamp, data string"


def read_changes(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", files).parquet(path)


def admitted(source: str = "en", drafts: bool = True, operations: tuple[str, ...] = ("create", "update")) -> Column:
    """A missing flag, locale or status admits the change; globals are not held to an operation."""
    own = ~F.coalesce("is_auto", F.lit(False))
    here = F.coalesce(F.col("locale"), F.lit(source)).isin("", source)
    op = (F.col("entity_type") == "global") | F.coalesce(F.col("operation").isin(*operations), F.lit(False))
    draft = F.lit(drafts) | ~F.col("status").eqNullSafe("draft")
    return own & here & op & draft


def document_key() -> Column:
    return F.concat_ws(":", "entity_type", "slug", F.coalesce(F.col("doc_id").cast("string"), F.lit("global")))


def debounce(changes: DataFrame, gap: str, delay: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(key, job_id, ts, n, carry...): the last change of each quiet period of a document; a stream needs a watermark delay.

    carry names columns of that last change that come along, its document among them.
    """
    if changes.isStreaming:
        changes = changes.withWatermark("ts", delay or gap)
    last = F.max(F.struct("ts", "job_id"))
    more = [F.max_by(F.struct(*carry), F.struct("ts", "job_id")).alias("c")] if carry else []
    out = changes.groupBy(document_key().alias("key"), F.session_window("ts", gap)).agg(last.alias("x"), F.count("*").alias("n"), *more)
    return out.select("key", "x.job_id", "x.ts", "n", *(["c.*"] if carry else []))


def latest(changes: DataFrame) -> DataFrame:
    """(key, job_id, ts): the newest job of each document; combines before the shuffle."""
    return changes.groupBy(document_key().alias("key")).agg(F.max(F.struct("ts", "job_id")).alias("x")).select("key", "x.job_id", "x.ts")


def sync(changes: DataFrame, upsert: Callable[[DataFrame, int], None], checkpoint: str, gap: str = "1 second"):
    """Runs admitted, debounced changes through `upsert(batch, epoch)`, each batch reduced to its newest jobs."""

    def each(batch: DataFrame, epoch: int) -> None:
        newest = batch.groupBy("key").agg(F.max(F.struct("ts", "job_id", "n")).alias("x")).select("key", "x.*")
        upsert(newest.withColumn("is_auto", F.lit(True)), epoch)

    ready = debounce(changes.where(admitted()), gap)
    return ready.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What a change brings along through the debounce.
CARRIED = ("entity_type", "slug", "status", "data")


def synced_documents(changes: DataFrame, existing: DataFrame, tm: DataFrame, locales: list[str], source: str = "en", options: SyncOptions | None = None) -> DataFrame:
    """(key, locale, ts, draft, doc, error): what the newest admitted change of each document makes of its translations.

    changes hold the source document as JSON in `data`; existing (key, locale, doc) are the present translations. Strings
    go through the memory, what people have filled in stays, ids get the locale, fields of the database are dropped.
    """
    newest = changes.where(admitted(source)).groupBy(document_key().alias("key")).agg(F.max_by(F.struct("ts", *CARRIED), F.struct("ts", "job_id")).alias("x")).select("key", "x.*")
    return synced(settled(newest), existing, tm, options or SyncOptions(tuple(locales), source))


def continuous_sync(changes: DataFrame, store: KeyedStore, tm: DataFrame, options: SyncOptions, path: str, gap: str = "1 second", delay: str | None = None, call=None, compact_every: int = 100):
    """Starts the job that keeps the store of documents (key, locale) in step with a stream of changes.

    Changes are admitted and debounced with their documents; each micro-batch keeps the newest of a document, reads the present translations
    from the buckets of its keys, and puts its outcome into the store as the change set of its epoch. What fails goes to
    `path`/failed, by epoch, and does not hold up the other documents or locales; `path`/log has a row an epoch, written last. An epoch that is
    run again after a failure sees the store as it was before it and replaces its own files, so nothing is applied twice.
    """
    spark = changes.sparkSession

    def each(batch: DataFrame, epoch: int) -> None:
        newest = batch.groupBy("key").agg(F.max_by(F.struct("ts", *CARRIED), F.struct("ts", "job_id")).alias("x"), F.sum("n").alias("n")).select("key", "n", "x.*")
        newest = settled(newest)
        asked = newest.select("key", F.explode(F.array(*(F.lit(x) for x in options.locales))).alias("locale"))
        existing = store.read(before=epoch, keys=asked).where("doc IS NOT NULL")
        done = settled(synced(newest, existing, tm, options, call))
        write_documents(store, done.where("error IS NULL"), epoch)
        failed = done.where("error IS NOT NULL").join(newest.select("key", "data"), "key")
        failed.select("key", "locale", "ts", "error", "data").write.mode("overwrite").parquet(f"{path}/failed/epoch={epoch}")
        log = done.agg(F.count_if(F.col("error").isNull()).alias("completed"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.max("ts").alias("last_ts"), F.max_by("error", F.when(F.col("error").isNotNull(), F.struct("ts", "key", "locale"))).alias("last_error"))
        log.crossJoin(newest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("changes"))).write.mode("overwrite").parquet(f"{path}/log/epoch={epoch}")
        if compact_every and epoch % compact_every == compact_every - 1:
            store.compact()

    ready = debounce(changes.where(admitted(options.source)), gap, delay, CARRIED)
    return ready.writeStream.foreachBatch(each).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def sync_stats(spark: SparkSession, path: str) -> DataFrame:
    """(changes, completed, failed, last_ts, last_error) over the log of a continuous_sync: changes taken in, translations written and failed."""
    log = spark.read.parquet(f"{path}/log")
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("changes", "completed", "failed")]
    return log.agg(*total, F.max("last_ts").alias("last_ts"), F.max_by("last_error", F.when(F.col("last_error").isNotNull(), F.col("epoch"))).alias("last_error"))


def job_stats(log: DataFrame) -> DataFrame:
    """(state, n, last_ts, last_job, last_error) of a job log (state, ts, job_id, error: null if none)."""
    last = F.max_by("error", F.when(F.col("error").isNotNull(), F.struct("ts", "job_id")))
    return log.groupBy("state").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"), F.max(F.struct("ts", "job_id"))["job_id"].alias("last_job"), last.alias("last_error"))
