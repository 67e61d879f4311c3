"""Queries of round 3's findings with few rows a task: rows are dealt out, target rows are merged, results are their SQL's."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_queries import duck, rows  # noqa: F401
from test_scale import DIR, plan

from lingualake.operators import database as DB
from lingualake.operators import documents as D
from lingualake.plans import fixtures as X
from lingualake.plans import registry
from lingualake.sources import store as S
from lingualake.sources import tables

#: Finding and query.
NAMES = {
    "F5": "backfill_run",
    "F6": "backfill_report",
    "F7": "collect_missing_leaves",
    "F8": "richtext_needs",
    "F9": "database_strings",
    "F10": "tables_with_source",
    "F15": "union_changes",
    "F16": "build_inserts_richtext",
    "F18": "build_updates",
}


@pytest.mark.parametrize("finding", NAMES)
def test_target_rows_are_dealt_out_and_merged(spark, duck, monkeypatch, finding):  # noqa: F811
    """One task read the file of part, and target rows were broadcast by the file's compressed bytes."""
    for module, name, value in ((X, "PARTS_IN_TASK", 30), (tables, "TASK_ROWS", 60), (S, "FEW", 50)):
        monkeypatch.setattr(module, name, value, raising=False)
    plans, settled = [], DB.settled
    monkeypatch.setattr(DB, "settled", lambda df: plans.append(plan(df)) or settled(df))
    run, sql = registry.ENTRIES[NAMES[finding]]
    out = run(spark, DIR)
    matched = [p for p in [*plans, plan(out)] if "__by#" in p]
    assert matched and all("SortMergeJoin [__by#" in p and "REPARTITION_BY_NUM" in p for p in matched)
    assert rows(out.toPandas()) == rows(duck.execute(sql).df())


def test_equal_rich_text_is_parsed_once(monkeypatch):
    """each row's rich text was parsed, however often it comes."""
    a, b, bad = ('{"root": {"children": [{"type": "text", "text": "%s"}]}}' % x for x in ("a", "b\\u0000c", '"'))
    seen, loads = [], json.loads
    monkeypatch.setattr(D.json, "loads", lambda x: seen.append(x) or loads(x))
    got = D.richtext_parts.func(pd.Series([a, None, b, a, bad, a, None, bad], dtype=object))
    assert sorted(seen) == sorted([a, b, bad])
    assert [(p, x) for p, x in zip(got["present"], got["leaves"])] == [(True, ["a"]), (False, None), (True, ["b\0c"]), (True, ["a"]), (True, None), (True, ["a"]), (False, None), (True, None)]
    assert got["form"][0] == got["form"][3] != got["form"][2] and got["form"][1] is None


@pytest.mark.parametrize("rows, tasks", [(150, 150), (450, 200)])
def test_dealing_out_does_not_sort(spark, tmp_path, monkeypatch, rows, tasks):
    """Dealt to more than 200 tasks, as at 6 GB, a small file's rows were all held by the one task that reads it."""
    spark.range(rows).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(X, "PARTS_IN_TASK", 1)
    out = X.parts(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == tasks
    assert sorted(r[0] for r in out.collect()) == list(range(rows))
