"""A table as a base and numbered change sets, put together when it is read: keyed upserts on plain files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import dealt

#: So many changes may be sent to the base's files, if Spark finds them small; of more, their compressed bytes say too little.
FEW = 10_000


class KeyedStore:
    """A table under `path` whose rows are known by `keys`; a null in a key is a value like any other.

    `base/set=n` holds the whole table after change set n, `delta/set=n` one change set. Both are laid out by a hash of the
    key, so a read for some keys opens their buckets alone. A set counts once its writer has finished; one written again
    under its number replaces itself, so a job that is started anew after a failure changes nothing twice.

    A change has an `op`:
    - insert: the row, unless its key is there already (in the base, or by an earlier set);
    - update: the columns named in `changed`, if the key is there; of several updates of a column the last set's counts;
    - upsert: an insert, or an update of every column.
    Within a set inserts come before updates, and of several changes of one column the greatest value counts.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 32):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets

    def _sets(self, kind: str) -> list[int]:
        """Numbers of the finished sets of a kind."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        found = [s.getPath() for s in fs.listStatus(top) if s.getPath().getName().startswith("set=")]
        return sorted(int(p.getName()[4:]) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _drop(self, kind: str, number: int) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/set={number}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, kind: str, number: int) -> None:
        laid = df.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        laid.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{kind}/set={number}")

    def create(self, base: DataFrame) -> None:
        """The table before any change set; its schema is the store's."""
        base.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")  # sets may be empty, and then have no file that tells it
        self._write(base, "base", -1)

    def schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def put(self, number: int, changes: DataFrame) -> None:
        """Writes a change set (op, the keys, any of the columns, `changed` for updates)."""
        if number < 0 or self.base() >= number:
            raise ValueError(f"change set {number} is part of the base already")
        cells = [(F.col(f.name) if f.name in changes.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema()]
        changed = F.col("changed") if "changed" in changes.columns else F.lit(None)
        self._write(changes.select(*cells, "op", changed.cast("array<string>").alias("changed")), "delta", number)

    def base(self) -> int:
        """The last change set that is part of the base; -1: none."""
        sets = self._sets("base")
        if not sets:
            raise ValueError(f"no table at {self.path}")
        return sets[-1]

    def _read(self, kind: str, numbers: list[int]) -> DataFrame:
        """Sets with their number as a column, `bucket` as it is in the path."""
        paths = [f"{self.path}/{kind}/set={n}" for n in numbers]
        own = self.schema()
        if kind == "delta":
            own = own.add("op", "string").add("changed", T.ArrayType(T.StringType()))
        one = self.spark.read.schema(own.add("set", T.IntegerType()).add("bucket", T.IntegerType())).option("basePath", f"{self.path}/{kind}").parquet(*paths)
        return one if kind == "delta" else one.drop("set")

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table, or what it was before a change set, or the buckets that some keys are in.

        Changes are put together for each key first, so where they are few, Spark sends them to the base's files instead of moving the base.
        """
        base = self.base()
        if before is not None and base >= before:
            raise ValueError(f"the base has change set {base} already")
        rows = self._read("base", [base])
        sets = [n for n in self._sets("delta") if n > base and (before is None or n < before)]
        delta = self._read("delta", sets) if sets else None
        if keys is not None:
            some = [r[0] for r in keys.select(self._bucket()).distinct().collect()]  # as many as there are buckets, at most
            rows, delta = rows.where(F.col("bucket").isin(some)), delta and delta.where(F.col("bucket").isin(some))
        rows = rows.drop("bucket")
        return rows if delta is None else self._resolved(rows, delta)

    def _resolved(self, base: DataFrame, delta: DataFrame) -> DataFrame:
        cols = [c for c in base.columns if c not in self.keys]
        new, every = F.col("op").isin("insert", "upsert"), F.col("op") == "upsert"

        def sets(c: str) -> Column:
            return every | ((F.col("op") == "update") & F.array_contains("changed", c))

        def keyed(df: DataFrame) -> DataFrame:
            return dealt(df.withColumn("__key", F.struct(*self.keys)), most, "__key")  # a struct is never null, and its nulls are equal

        def large(df: DataFrame, n: int) -> DataFrame:
            return df.hint("merge") if n > FEW else df

        n, held = delta.count(), base.count()
        most = max(n, held) if n > FEW else n
        first = F.min(F.when(new, F.struct("set", *(F.col(c).alias(f"c{i}") for i, c in enumerate(cols))))).alias("__new")
        last = [F.max(F.when(sets(c), F.struct("set", F.col(c).alias("to")))).alias(f"__u{i}") for i, c in enumerate(cols)]
        change = keyed(delta).groupBy("__key").agg(first, *last)
        old = keyed(base) if n > FEW else base.withColumn("__key", F.struct(*self.keys))
        kept = [F.when(F.col(f"__u{i}").isNotNull(), F.col(f"__u{i}.to")).otherwise(F.col(c)).alias(c) for i, c in enumerate(cols)]
        there = large(old.select("__key"), held)
        old = old.join(large(change, n), "__key", "left").select(*self.keys, *kept)
        added = change.where("__new IS NOT NULL").join(there, "__key", "left_anti")
        later = [F.when(F.col(f"__u{i}.set") >= F.col("__new.set"), F.col(f"__u{i}.to")).otherwise(F.col(f"__new.c{i}")).alias(c) for i, c in enumerate(cols)]
        return old.unionByName(added.select(*(F.col("__key")[k].alias(k) for k in self.keys), *later)).select(*base.columns)

    def compact(self, keep: int = 1) -> int:
        """Puts all change sets but the last `keep` (which may be written again) into a new base, then frees the old files.

        Gives the base's number. A compaction that is cut off leaves the old base in force.
        """
        done = self.base()
        rest = [n for n in self._sets("delta") if n > done]
        if len(rest) <= keep:
            return done
        upto = rest[len(rest) - keep - 1]
        after = rest[len(rest) - keep] if keep else None
        self._write(self.read(before=after), "base", upto)
        for n in self._sets("base")[:-1]:
            self._drop("base", n)
        for n in rest:
            if n <= upto:
                self._drop("delta", n)
        return upto
