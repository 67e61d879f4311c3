"""What several operators share: reading tables, cutting lineage, word expressions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D, nothing else.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: A side of at most so many narrow rows (an id or two: some 16 MB) is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; where none is set, a folder beside a local session's warehouse."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}-steps"
        sc.setCheckpointDir(found)
    return found


_OPEN: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Frees, at its end, the files of every cut() made inside: for steps whose result is written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        release(*_OPEN.pop())


def cut(df: DataFrame, keep: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends there, and a lost executor loses nothing.
    What the write shuffled is freed at once, not when the driver next collects its garbage.

    Files that are not to be kept go at the end of the scratch() around the call, if there is one."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    if _OPEN and not keep:
        _OPEN[-1].append(out)
    return out


def release(*cuts: DataFrame) -> None:
    """Deletes the files of results of cut() that nothing reads any more."""
    for df in cuts:
        spark = df.sparkSession
        for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            if path.rsplit("/", 1)[1].startswith("cut-"):
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df marked for broadcast if it was counted and is small; else as it is, for a shuffled join."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def numbered(df: DataFrame, name: str, stored: bool = False) -> DataFrame:
    """df with a number for each row that is the same whenever df is read; dense within each partition or file.

    stored tells that df is the rows of a table's files as they are: file and place give the number, and no copy of the rows is
    written. Anything else, and files whose reader tells no places, go through cut()."""
    if stored:
        try:
            placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
        except AnalysisException:
            pass
        else:
            files = sorted(r[0] for r in placed.select("__file").distinct().collect())
            known = df.sparkSession.createDataFrame([(f, k << 33) for k, f in enumerate(files)], "__file string, __first long")
            return placed.join(F.broadcast(known), "__file").withColumn(name, F.col("__first") + F.col("__place")).drop("__file", "__place", "__first")
    return cut(df.withColumn(name, F.monotonically_increasing_id()))


def among(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows of df whose number is in ids (column): df stays where it is, bitmaps of some bits a number go to it.

    For numbers by numbered(), which are dense within each partition or file: 4 KB for 32,768 in a row."""
    number, at = F.bitmap_bucket_number(column), F.bitmap_bit_position(column)
    bits = ids.groupBy(number.alias("__bucket")).agg(F.bitmap_construct_agg(at).alias("__bits"))
    byte = F.conv(F.hex(F.substr("__bits", F.floor(at / F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return df.withColumn("__bucket", number).join(F.broadcast(bits), "__bucket").where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*df.columns)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a text in order, as an array (a null text has none)."""
    return F.filter(F.split(whole(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")
