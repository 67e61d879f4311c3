"""The keyed store against plain dictionaries: inserts, updates and upserts in any order, replays, compaction, null keys."""

import random

import pytest
from pyspark.sql import functions as F

from lingualake.sources.store import KeyedStore

SCHEMA = "k string, l string, a string, b long"
CHANGE = f"op string, {SCHEMA}, changed array<string>"


def replayed(base, sets):
    """What the rules say, one change at a time."""
    table = {(k, lo): {"a": a, "b": b} for k, lo, a, b in base}
    for rows in sets:
        fresh = {}
        for op, k, lo, a, b, _ in rows:
            if op in ("insert", "upsert") and (k, lo) not in table:
                fresh.setdefault((k, lo), []).append((a, b))
        for key, some in fresh.items():
            a, b = min(some, key=lambda r: tuple((x is not None, x) for x in r))
            table[key] = {"a": a, "b": b}
        best = {}
        for op, k, lo, a, b, changed in rows:
            if (k, lo) in table and op in ("update", "upsert"):
                for c, v in (("a", a), ("b", b)):
                    if op == "upsert" or c in changed:
                        best.setdefault((k, lo, c), []).append(v)
        for (k, lo, c), some in best.items():
            table[k, lo][c] = max(some, key=lambda x: (x is not None, x))
    return {(*key, v["a"], v["b"]) for key, v in table.items()}


def rows_of(df):
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def test_store_follows_its_rules(spark, tmp_path):
    rng = random.Random(7)
    keys = [(k, lo) for k in ("p1", "p2", "p3", None, "p5") for lo in ("es", None)]
    base = [(*k, f"base{i}", i) for i, k in enumerate(keys[:5])]
    sets = []
    for n in range(5):
        rows = []
        for _ in range(9):
            op = rng.choice(["insert", "update", "upsert"])
            changed = rng.choice([["a"], ["b"], ["a", "b"]]) if op == "update" else None
            rows.append((op, *rng.choice(keys), rng.choice([None, f"v{n}"]), rng.randrange(100), changed))
        sets.append(rows)
    store = KeyedStore(spark, str(tmp_path / "t"), ["k", "l"], buckets=4)
    store.create(spark.createDataFrame(base, SCHEMA))
    assert rows_of(store.read()) == set(base)
    for n, rows in enumerate(sets):
        store.put(n, spark.createDataFrame(rows, CHANGE))
    assert rows_of(store.read()) == replayed(base, sets)
    assert rows_of(store.read(before=2)) == replayed(base, sets[:2])
    store.put(4, spark.createDataFrame(sets[4], CHANGE))  # the last set once more
    assert rows_of(store.read()) == replayed(base, sets)
    some = store.read(keys=spark.createDataFrame([("p1", "es")], "k string, l string")).where("k = 'p1' AND l = 'es'")
    assert rows_of(some) == {r for r in replayed(base, sets) if r[:2] == ("p1", "es")}
    assert store.compact() == 3
    assert rows_of(store.read()) == replayed(base, sets) and rows_of(store.read(before=4)) == replayed(base, sets[:4])
    with pytest.raises(ValueError):
        store.put(3, spark.createDataFrame(sets[3], CHANGE))
    store.put(5, spark.createDataFrame([("update", "p1", "es", "last", 0, ["a"])], CHANGE))
    assert store.compact(keep=0) == 5 and ("p1", "es", "last") in {r[:3] for r in rows_of(store.read())}


def test_unfinished_sets_do_not_count(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "t"), ["k"], buckets=2)
    store.create(spark.createDataFrame([("x", 1)], "k string, b long"))
    store.put(0, spark.createDataFrame([("insert", "y", 2)], "op string, k string, b long"))
    (tmp_path / "t" / "delta" / "set=0" / "_SUCCESS").unlink()
    assert rows_of(store.read()) == {("x", 1)}


def test_few_changes_are_broadcast(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "t"), ["k"], buckets=2)
    store.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("a")))
    store.put(0, spark.createDataFrame([("update", 5, "w", ["a"])], "op string, k long, a string, changed array<string>"))
    df = store.read()
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
