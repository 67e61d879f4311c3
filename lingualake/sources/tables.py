"""Reading tables, discovering localized ones, and ending lineage in a shared folder."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Rows that one task takes in where they are dealt out by their number.
TASK_ROWS = 100_000
#: Bytes of JSON that one task takes in where a Python helper works on them: Arrow's batches of 10,000 rows are held whole, in several forms.
TASK_BYTES = 4_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local session's is beside its warehouse."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}-steps"
        sc.setCheckpointDir(found)
    return found


def workspace(spark: SparkSession) -> str:
    """A new folder of its own in the shared one."""
    return f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df with its lineage cut: written to the shared folder, once, and read again; a lost executor loses nothing."""
    path = f"{workspace(df.sparkSession)}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, *keys: str, most: int | None = None) -> DataFrame:
    """df by keys in as many tasks as so many rows (or bytes, if most of them in a task is given) ask for; as it is where the session's shuffle partitions are enough.

    Two sides of a join that are dealt by its keys for the same number of rows do not move again.
    """
    n = -(-rows // (most or TASK_ROWS))
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def settled_with(df: DataFrame, measure: Column) -> tuple[DataFrame, Any]:
    """settled(df), and an aggregate of its rows that the write itself observes, so that it takes no job of its own."""
    seen = Observation()
    out = settled(df.observe(seen, measure.alias("m")))
    return out, seen.get["m"]


def localized_tables(columns: DataFrame, only: list[str] | None = None, versions: bool = False) -> DataFrame:
    """(table) of a catalog listing (table, column, type): tables that have a _locale column."""
    t = F.col("table")
    found = columns.where("column = '_locale'").select("table").distinct()
    keep = ~t.startswith("_") | (F.lit(versions) & t.contains("_v_"))
    if only is not None:
        some = F.lit(False)
        for name in only:
            some = some | (t == name) | t.startswith(f"{name}_")
        keep = keep & some
    return found.where(keep).orderBy("table")


def columns_of(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """The catalog listing (table, column, type) that localized_tables takes, from the tables' schemas."""
    return [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
