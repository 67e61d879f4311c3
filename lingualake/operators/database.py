"""Backfill of a whole database: every localized table, each string translated once, one change set a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.filters import is_translatable_field, should_skip_value
from ..functions.text import is_echo
from ..sources.sinks import write_changes
from ..sources.store import KeyedStore
from ..sources.tables import settled
from . import backfill as B
from .strings import except_translated, memory, translate

#: One row for each field of each source row and locale that is to be translated.
LONG = "table string, key string, locale string, field string, src string, has_target boolean"


@dataclass
class Table:
    """A localized table: its rows, fields of rich text, whether its parent's ids carry a locale, other columns that new rows take over."""

    rows: DataFrame
    rich: Sequence[str] = ()
    parent_localized: bool = False

    def fields(self, excluded: Sequence[str] = ()) -> list[str]:
        """Text columns whose name is translatable."""
        own = ("id", "_uuid", "_parent_id", "_locale", "published_locale")
        return [f.name for f in self.rows.schema if f.dataType.simpleString() == "string" and f.name not in own and is_translatable_field(f.name, excluded)]

    def others(self, excluded: Sequence[str] = ()) -> list[str]:
        own = ("id", "_uuid", "_parent_id", "_locale", "published_locale")
        return [c for c in self.rows.columns if c not in own and c not in self.fields(excluded)]


@dataclass
class Backfill:
    """What a database lacks: per table the matched rows; over all tables the fields in need, the strings, and the memory with what was translated."""

    tables: dict[str, Table]
    matched: dict[str, DataFrame]
    gate: DataFrame
    strings: DataFrame
    memory: DataFrame
    failed: DataFrame
    errors: dict[str, str] = field(default_factory=dict)
    excluded: Sequence[str] = ()
    rules: dict = field(default_factory=dict)

    def whole(self) -> Backfill:
        """The plan, if no table failed: rows made of it would else lack a table and look like a result."""
        if self.errors:
            raise RuntimeError("tables not planned: " + "; ".join(f"{name}: {error}" for name, error in sorted(self.errors.items())))
        return self


def localized(tables: dict[str, Table], only: Sequence[str] | None = None, versions: bool = False) -> list[str]:
    """Names of the tables with a _locale column: not those that begin with `_` (unless versions are asked for and it is one), and of
    `only` and what begins with its names and `_`."""
    names = [n for n, t in sorted(tables.items()) if "_locale" in t.rows.columns]
    names = [n for n in names if not n.startswith("_") or versions and "_v_" in n]
    return [n for n in names if only is None or any(n == x or n.startswith(f"{x}_") for x in only)]


def long_form(name: str, matched: DataFrame, fields: list[str], rich: Sequence[str], **rules) -> DataFrame:
    """LONG of one table: a field's text, or a row for each leaf of its rich text, where the field needs translation."""
    cells = []
    for f in fields:
        texts = F.filter(F.col(f"sp_{f}.leaves"), lambda x: ~should_skip_value(x, **rules)) if f in rich else F.array(F.col(f"s_{f}"))
        cells.append(F.transform(F.when(F.col(f"n_{f}"), texts), lambda x, f=f: F.struct(F.lit(f).alias("field"), x.alias("src"))))
    every = F.flatten(F.array_compact(F.array(*cells)))
    return matched.select(F.lit(name).alias("table"), "key", "locale", F.explode(every).alias("x"), "has_target").select("table", "key", "locale", "x.field", "x.src", "has_target")


def plan_backfill(tables: dict[str, Table], locales: list[str], tm: DataFrame, source: str = "en", only: Sequence[str] | None = None, versions: bool = False, excluded: Sequence[str] = (), call: Callable[[list[str], str], list[str]] | None = None, **rules) -> Backfill:
    """What the localized tables need in each locale. Tables may differ in every column but _locale and the keys.

    Each table is matched once, whatever reads it later. The tables' needs are one long relation: which (table, locale) has work at all is asked of it, and its different strings over all tables
    are looked up, and those the memory lacks translated by `call`, once for the whole database. A table that cannot be planned is
    named in errors, the others go on: run_backfill logs it, and what gives the plan's rows asks for whole() first. rules are the value rules' custom exclusions.
    """
    spark = tm.sparkSession
    long, matched, errors = spark.createDataFrame([], LONG), {}, {}
    for name in localized(tables, only, versions):
        t = tables[name]
        try:
            fields = t.fields(excluded)
            if not fields:
                continue
            m = settled(B.with_needs(B.match_target_rows(t.rows, locales, fields, source, t.parent_localized, t.others(excluded), t.rich), fields, t.rich, **rules))
            long = long.unionByName(long_form(name, m, fields, t.rich, **rules))
            matched[name] = m
        except Exception as e:  # noqa: BLE001  a table's failure is that table's, by name in the log and in whole()
            errors[name] = str(e).split("\n")[0][:300]
    long = settled(long)
    gate = settled(long.select("table", "locale").distinct())
    needed = settled(long.select("locale", "src").distinct())
    known = tm.select("target_locale", "src", "tgt")
    failed = needed.limit(0).select("locale", "src")
    if call is not None:
        fresh = settled(translate(except_translated(needed, tm), call))
        echo = F.coalesce(is_echo(F.col("tgt"), F.col("src"), F.col("locale")), F.lit(True))
        known = known.unionByName(fresh.where(~echo).select(F.col("locale").alias("target_locale"), "src", "tgt"))
        failed = fresh.where(F.col("failed") | echo).select("locale", "src")
    return Backfill(tables, matched, gate, long, memory(known), failed, errors, excluded, rules)


def change_sets(plan: Backfill, name: str) -> tuple[DataFrame, DataFrame]:
    """(updates, inserts) of one table: the long relation split back, in the locales in which this table has work."""
    if name in plan.errors:
        raise RuntimeError(f"{name} was not planned: {plan.errors[name]}")
    t, fields = plan.tables[name], plan.tables[name].fields(plan.excluded)
    here = F.broadcast(plan.gate.where(F.col("table") == name).select("locale"))  # the locales, at most
    m = plan.matched[name].join(here, "locale", "left_semi")
    updates = B.update_rows(m, plan.memory, fields, t.rich, t.parent_localized, gated=True, **plan.rules)
    inserts = B.build_inserts(m, plan.memory, fields, every=True, parent_localized=t.parent_localized, others=t.others(plan.excluded), rich=t.rich, **plan.rules)
    return updates, inserts


def backfill_report(plan: Backfill) -> DataFrame:
    """(table, locale, strings, translated, failed, rows_seen, to_insert, to_update, skipped): what a run over the plan does.

    strings are the different ones that a table needs in a locale, translated those for which the memory has another text, failed those that the
    translator could not do. Rows of a locale without work are skipped.
    """
    rows = None
    for name, m in plan.matched.items():
        part = m.select(F.lit(name).alias("table"), "locale", "has_target", "needs")
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return plan.strings.sparkSession.createDataFrame([], "table string, locale string, strings long, translated long, failed long, rows_seen long, to_insert long, to_update long, skipped long")
    work = rows.join(F.broadcast(plan.gate.withColumn("work", F.lit(True))), ["table", "locale"], "left").withColumn("work", F.coalesce("work", F.lit(False)))
    counts = work.groupBy("table", "locale").agg(
        F.count("*").alias("rows_seen"),
        F.count_if(F.col("work") & ~F.col("has_target")).alias("to_insert"),
        F.count_if(F.col("work") & F.col("has_target") & F.col("needs")).alias("to_update"),
        F.count_if(~F.col("work") | F.col("has_target") & ~F.col("needs")).alias("skipped"),
    )
    each = plan.strings.select("table", "locale", "src").distinct()
    done = plan.memory.where("__t <> '' AND __t <> __s").select(F.col("__l").alias("locale"), F.col("__s").alias("src"), F.lit(True).alias("done"))
    each = each.join(done, ["locale", "src"], "left").join(plan.failed.withColumn("bad", F.lit(True)).distinct(), ["locale", "src"], "left")
    strings = each.groupBy("table", "locale").agg(F.count("*").alias("strings"), F.count_if("done").alias("translated"), F.count_if("bad").alias("failed"))
    zero = F.lit(0).cast("long")
    return counts.join(strings, ["table", "locale"], "left").select("table", "locale", *(F.coalesce(c, zero).alias(c) for c in ("strings", "translated", "failed")), "rows_seen", "to_insert", "to_update", "skipped")


def run_backfill(plan: Backfill, stores: dict[str, KeyedStore], number: int, log: str) -> DataFrame:
    """Writes each table's change set into its store and gives the log (table, status, updated, inserted, error, started, ended).

    Counts are observed while the rows are written. A table that fails is logged with its error and does not stop the others; run again under
    its number, a run replaces its own change sets and log.
    """
    spark = plan.strings.sparkSession
    rows = [(name, "failed", 0, 0, error, time.time(), time.time()) for name, error in plan.errors.items()]
    for name in plan.matched:
        began, seen = time.time(), [Observation(), Observation()]
        try:
            sets = [df.observe(o, F.count("*").alias("n")) for df, o in zip(change_sets(plan, name), seen)]
            write_changes(stores[name], number, *sets)
            rows.append((name, "completed", seen[0].get["n"], seen[1].get["n"], None, began, time.time()))
        except Exception as e:  # noqa: BLE001  a table's failure is that table's
            rows.append((name, "failed", 0, 0, str(e).split("\n")[0][:300], began, time.time()))
    schema = "table string, status string, updated long, inserted long, error string, started double, ended double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{log}/run={number}")
    return run_log(spark, log)


def run_log(spark: SparkSession, log: str) -> DataFrame:
    """The log of all runs, times as timestamps."""
    rows = spark.read.parquet(log)
    return rows.withColumns({c: F.timestamp_micros((F.col(c) * 1_000_000).cast("long")) for c in ("started", "ended")})
