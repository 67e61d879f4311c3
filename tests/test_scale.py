"""Joins of whole tables do not rest on the compressed bytes of their files, and rows are dealt out by their number."""

import pytest
from pyspark.sql import functions as F

from lingualake.operators import backfill as B
from lingualake.plans import fixtures as X
from lingualake.plans import registry
from lingualake.sources import store as S
from lingualake.sources import tables
from lingualake.sources.store import KeyedStore
from lingualake.sources.tables import workspace

DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_target_rows_are_not_broadcast(spark):
    """the planner took 20 compressed bytes a row for a table's size."""
    assert "BroadcastHashJoin" not in plan(registry._matched(spark, DIR))
    assert "BroadcastHashJoin" not in plan(registry._rich(spark, DIR))


def test_store_sends_few_changes_only(spark, monkeypatch):
    """neither the changes nor the base's keys go to every executor where they are many; a null in a key is a value."""

    def stored():
        store = KeyedStore(spark, workspace(spark), ["a", "b"], 2)
        rows = spark.range(60).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("a"), (F.col("id") % 4).cast("string").alias("b"), F.col("id").cast("string").alias("v"))
        store.create(rows.where("v < '40'").dropDuplicates(["a", "b"]))
        store.put(0, rows.withColumn("v", F.concat(F.lit("n"), "v")).withColumn("op", F.lit("upsert")))
        return store.read()

    few = stored()
    monkeypatch.setattr(S, "FEW", 3)
    monkeypatch.setattr(tables, "TASK_ROWS", 7)
    many = stored()
    assert "BroadcastHashJoin" not in plan(many)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert many.where("a IS NULL AND b IS NOT NULL").count() == 4


@pytest.mark.parametrize("name", ["build_updates_richtext", "match_target_rows_numbered", "write_changes_without_id"])
def test_rows_are_dealt_out(spark, monkeypatch, name):
    """Results do not depend on how many tasks rows are dealt to."""
    want = sorted(map(str, registry.ENTRIES[name][0](spark, DIR).collect()))
    monkeypatch.setattr(tables, "TASK_ROWS", 40)
    monkeypatch.setattr(X, "PARTS_IN_TASK", 30)
    monkeypatch.setattr(S, "FEW", 50)
    assert sorted(map(str, registry.ENTRIES[name][0](spark, DIR).collect())) == want


def test_tasks_grow_with_rows(spark, monkeypatch):
    """One task took a small file's rows, whatever they became."""
    monkeypatch.setattr(X, "PARTS_IN_TASK", 30)
    monkeypatch.setattr(tables, "TASK_ROWS", 40)
    catalog = X.fixture(spark, DIR, X.CATALOG)
    assert catalog.rdd.getNumPartitions() >= -(-X.read(spark, DIR, "part").count() // 30) == 7
    assert f", {-(-catalog.count() // 40)})" in plan(B.match_target_rows(catalog, ["es"], ["title"]))


def test_tables_are_matched_once(spark):
    """every reader of a plan matched its tables, and parsed their rich text, again; changes were broadcast."""
    made = registry._database(spark, DIR)
    for name, matched in made.matched.items():
        assert "Join" not in plan(matched) and "ArrowEvalPython" not in plan(matched)
        for changes in registry.DB.change_sets(made, name):  # beside the locales of the gate and the memory, which the two sides' lookups share
            assert "SortMergeJoin" in plan(changes) or name == "imported"


def test_rules_and_jsonld_are_dealt_out(spark, monkeypatch):
    """redirect rules and pages were grouped by as many tasks as the session says, whatever their number."""
    names = ["redirect_rules", "redirect_rules_old_slugs", "localize_jsonld"]
    want = [sorted(map(str, registry.ENTRIES[n][0](spark, DIR).collect())) for n in names]
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    for n, rows in zip(names, want):
        out = registry.ENTRIES[n][0](spark, DIR)
        assert "REPARTITION_BY_NUM" in plan(out)
        assert sorted(map(str, out.collect())) == rows


@pytest.mark.parametrize("name", ["write_changes", "write_changes_without_id"])
def test_written_changes_are_matched_once(spark, monkeypatch, name):
    """each of the updates and inserts of each of the two writes matched the table again, and twice so."""
    plans, write = [], registry.write_changes
    monkeypatch.setattr(registry, "write_changes", lambda store, n, *sets: plans.extend(map(plan, sets)) or write(store, n, *sets))
    registry.ENTRIES[name][0](spark, DIR)
    assert len(plans) == 4 and not any("p_partkey" in p for p in plans)


def test_documents_are_dealt_out_by_bytes(spark, monkeypatch):
    """a task's Python took in as many documents as Arrow's batches have rows, whatever their size."""
    want = sorted(map(str, registry._synced(spark, DIR).collect()))
    monkeypatch.setattr(tables, "TASK_BYTES", 5000)
    out = registry._synced(spark, DIR)
    assert plan(out).count("REPARTITION_BY_NUM") >= 2
    assert sorted(map(str, out.collect())) == want
