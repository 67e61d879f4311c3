"""Embedding near-dedup by spherical-cap filters: structured random product codes, list decoding, exact check.

A filter is a direction; a vector belongs to every filter whose direction is close enough (a spherical cap). The directions
are a product code: each half of a randomly rotated space has its own short list of random vectors, a direction is a pair
of them. So a vector finds all its filters by sorting two short lists of inner products, not by trying every pair. The
directions of one code depend on each other, and some vectors fall in none of its caps; so there are several codes with
rotations of their own. How often a pair at the threshold shares a filter of one code is measured on drawn pairs of the real
dimension; that sets the number of codes which the asked recall needs. Sharing makes candidates, their exact cosine decides.

Equal vectors are one class with a count. A filter's members are compared in blocks of bounded size as matrices; a pair is
counted in the smallest filter that both belong to, so blocks give sums and labels, never lists of all pairs.
"""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, small
from .components import components

#: Vectors of a filter compared at once.
BLOCK = 1024
#: Classes that a filter holds of `n` at random, and filters of one code that a vector falls in.
LOAD, CAPS = 512, 1.0
#: Pairs and codes drawn to measure how often a pair at the threshold shares a filter of a code.
DRAWN = (240, 6)


def codes(dim: int, length: int, number: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rotation and the two lists of one code."""
    rng = np.random.default_rng([seed, dim, number])
    turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    half = max(1, dim // 2)
    return turn, rng.normal(size=(half, length)), rng.normal(size=(max(1, dim - half), length))


def decode(unit: np.ndarray, code, height: float) -> list[np.ndarray]:
    """For each unit vector the sorted ids of all directions whose inner product exceeds the height."""
    turn, first, second = code
    x = unit @ turn
    half, length = first.shape
    rest = x[:, half:] if x.shape[1] > half else np.zeros((len(x), 1))
    a, b = x[:, :half] @ first, rest @ second
    out = []
    for u, v in zip(a, b):
        order = np.argsort(-v)
        many = np.searchsorted(-v[order], u - height, "right")  # list decoding: how far down the second list each entry reaches
        i = np.repeat(np.arange(length), many)
        j = order[np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)]
        out.append(np.sort(i * length + j))
    return out


@functools.cache
def plan(n: int, dim: int, threshold: float, recall: float) -> tuple[float, int, int]:
    """(cap height, list length of each half, number of codes) for n vectors: caps that hold LOAD of them at random, and as
    many codes as let a pair at the threshold share a filter with the probability `recall`, by the hit rate less its error."""
    share = min(0.3, LOAD / max(n, 1))
    height, length = NormalDist().inv_cdf(1 - share), max(2, math.ceil(math.sqrt(CAPS / share)))
    rng = np.random.default_rng([11, dim])
    x, y = rng.normal(size=(2, DRAWN[0], dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    y = threshold * x + math.sqrt(1 - threshold * threshold) * y
    hits = 0
    for k in range(DRAWN[1]):
        code = codes(dim, length, k)
        hits += sum(len(np.intersect1d(a, b, assume_unique=True)) > 0 for a, b in zip(decode(x, code, height), decode(y, code, height)))
    drawn = DRAWN[0] * DRAWN[1]
    rate = max(hits / drawn - 2 * math.sqrt(max(hits, 1)) / drawn, 0.01)
    return height, length, max(1, math.ceil(math.log(1 - recall) / math.log(1 - rate))) if rate < 1 else 1


def _counted(x: np.ndarray, cls: np.ndarray, copies: np.ndarray, part: np.ndarray, across: bool, mine: int, lists, threshold: float):
    """Links of one block: (class, linked vectors, smallest class of its group in the block)."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])  # by powers of two: no digit changes, no square over- or underflows
    norm = np.linalg.norm(x, axis=1)
    on = (x @ x.T) >= threshold * np.outer(norm, norm)
    np.fill_diagonal(on, False)
    if across:
        on &= part[:, None] != part[None, :]
    if not on.any():
        return None
    rows = np.flatnonzero(on.any(axis=1))
    on = on[np.ix_(rows, rows)]
    earlier = [lists[r][lists[r] < mine] for r in rows]
    ids = np.unique(np.concatenate(earlier))
    if len(ids):
        has = np.zeros((len(rows), len(ids)), np.float32)
        for k, e in enumerate(earlier):
            has[k, np.searchsorted(ids, e)] = 1
        once = on & ((has @ has.T) == 0)
    else:
        once = on
    label = cls[rows]
    while True:
        low = np.minimum(label, np.where(on, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (low == label).all():
            break
        label = low
    return cls[rows], once @ copies[rows], label


def near_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.97) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding).

    n_links is how many other rows have a cosine (double precision) of at least the threshold with this one and were found;
    component_id the smallest vec_id that links reach. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, and so do vectors of different length. Rows that repeat link with each other; a repeated
    vec_id names rows of their own. Other columns, and labels, are not read.
    """
    emb = F.col("embedding")
    if not isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType):  # single precision stays so on the way: no digit is lost
        emb = emb.cast("array<double>")
    good = F.coalesce((F.size(emb) > 0) & F.forall(emb, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(emb, lambda v: v != 0), F.lit(False))
    rows = cut(vectors.select("vec_id", F.when(good, emb).alias("v")).withColumn("k1", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn("k2", F.when(F.col("v").isNotNull(), F.hash("v"))))
    classes = rows.where("v IS NOT NULL").groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v")).withColumn("cls", F.xxhash64("k1", "k2"))
    known = rows.where("v IS NOT NULL").groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()  # one row a dimension
    plans = {r["dim"]: plan(r["n"], r["dim"], threshold, recall) for r in known}

    def cast(batches):
        for b in batches:
            dims = b.column(4).value_lengths().to_numpy()
            own: list = [None] * b.num_rows
            for dim in np.unique(dims):
                pick = np.flatnonzero(dims == dim)
                x = b.column(4).take(pa.array(pick)).flatten().to_numpy().astype(float).reshape(len(pick), dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                height, length, number = plans[dim]
                found = [[] for _ in pick]
                for k in range(number):
                    for mine, s in zip(found, decode(x, codes(dim, length, k), height)):
                        mine.append(s + k * length * length)
                for i, mine in zip(pick, found):
                    own[i] = np.concatenate(mine)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.list_(pa.int64()))], [*b.schema.names, "own"])

    classes = classes.select("cls", "copies", "k1", "k2", "v", "least")
    classes = cut(classes.mapInArrow(cast, T.StructType([*classes.schema.fields, T.StructField("own", T.ArrayType(T.LongType()))])))
    member = classes.select("cls", "copies", F.size("v").alias("dim"), F.explode("own").alias("filter"), "v", "own")
    big = cut(member.groupBy("filter", "dim").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK))
    block = member.join(small(big), ["filter", "dim"], "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / F.lit(BLOCK)), F.lit(1)).cast("int")).withColumn("part", F.pmod("cls", F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j")))
    block = block.withColumn("pair", F.explode(pair)).select("filter", "dim", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "part", "cls", "copies", "v", "own")
    keys = ["filter", "dim", "i", "j"]

    def check(batches):
        def blocks(t: pa.Table):
            key = np.stack([t[c].to_numpy() for c in keys], 1)
            edge = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
            dim, own = t["v"].combine_chunks(), t["own"].combine_chunks()
            flat, lists = dim.flatten().to_numpy(), own.flatten().to_numpy()
            v_at = np.concatenate([[0], np.cumsum(dim.value_lengths().to_numpy())])
            o_at = np.concatenate([[0], np.cumsum(own.value_lengths().to_numpy())])
            cls, copies, part = (t[c].to_numpy() for c in ("cls", "copies", "part"))
            found = []
            for a, e in zip([0, *edge], [*edge, len(key)]):
                if e - a > 1:
                    x = flat[v_at[a] : v_at[e]].astype(float).reshape(e - a, -1)
                    got = _counted(x, cls[a:e], copies[a:e], part[a:e], key[a, 2] != key[a, 3], key[a, 0], [lists[o_at[k] : o_at[k + 1]] for k in range(a, e)], threshold)
                    if got:
                        found.append(got)
            cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["cls", "links", "label"])

        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            last = np.ones(t.num_rows, bool)
            for c in keys:
                v = t[c].to_numpy()
                last &= v == v[-1]
            held = t.filter(pa.array(last))
            if not last.all():
                yield blocks(t.filter(pa.array(~last)))
        if held is not None:
            yield blocks(held)

    found = cut(block.repartition(*keys).sortWithinPartitions(*keys, "cls").mapInArrow(check, "cls long, links long, label long"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("cls").alias("a"), F.col("label").alias("b")))
    named = classes.select("cls", "k1", "k2", "copies", "least").join(links, "cls", "left").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(least, "comp").select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))
