"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Two sets with Jaccard similarity of at least t have sizes within the factor t, and share at least one of the first
n - ceil(t n) + 1 elements of each in any one order of all elements; of the smaller set (or either of two as large) the
first n - ceil(2 t n / (1 + t)) + 1 are enough (its front). The order here puts the elements that the whole
corpus holds most often last (by a counter table of fixed size), so that common passages seldom make candidates.
A tile is such an element together with a band of sizes. Inside a tile the parity bitmaps of two sets differ in at most
as many bits as the sets have elements outside their intersection; so a bit count bounds the overlap from above. Pairs
which that bound lets pass are candidates.

No list of pairs is ever written. Exact copies have one set and are one class. A tile puts out a spanning forest of its
candidates, at most one row for each member; the forests of all tiles make families, and every candidate pair lies within
one family. A family's sets come together once, in blocks of bounded size; there pairs are compared exactly, those that
links join already are passed over, and again a spanning forest of the links is all that leaves the block. A family of more
than one block also has its least class in each of them; what remains unjoined between its blocks follows in a second round, for the classes
that still have candidates in other components. So n near copies cost n rows, no link between components is lost.

The texts stay where they are; each step reads those it needs. What goes through the disk (elements, tiles, families' texts) goes in
rounds of bounded size, by a hash of what brings rows together, and a round's files are freed before the next.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vectext as V
from .common import among, cut, numbered, release, small
from .components import components

#: Words (of 64 bits) of the least bitmap and the elements it serves; larger sets have proportionally more: too few bits bound nothing.
WORDS, SERVES = 8, 1024
#: Counters of the frequency table: 2**18, of a fixed 1 MB at any corpus size.
COUNTER_BITS = 18
PARTS = 32
#: Classes of a tile or family compared at once, and elements of their sets; a larger one is cut into pairs of such blocks.
BLOCK, ELEMENTS = 2048, 1_000_000
#: An element that occurs more often than this (or than four times the mean counter) spreads over several tasks.
HOT_ROWS = 200_000
#: Rows of elements (some 17 bytes each as they are shuffled), rows of tiles (some 160) and elements of families' texts (some 5) of a round.
ROUND_PREFIXES, ROUND_TILES, ROUND_ELEMENTS = 100_000_000, 10_000_000, 200_000_000


def _sets(text: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for first, data, offs in V.chunks(text):
        for i, s in enumerate(V.shingles(V.LOWER[data], offs, k)):
            yield first + i, s


def _key(s: np.ndarray) -> int:
    x = np.add.reduce(V.mix(s), keepdims=True) ^ V.mix(np.bitwise_xor.reduce(s, keepdims=True) + np.uint64(len(s)))
    return int(V.mix(x).view(np.int64)[0])


def _width(n: int) -> int:
    return WORDS << max(0, -(-int(n) // SERVES) - 1).bit_length()


def _bitmap(s: np.ndarray, width: int | None = None) -> np.ndarray:
    """Bit i tells whether an odd number of the elements hash to i."""
    width = width or _width(len(s))
    bits = (s >> np.uint64(20)) % np.uint64(64 * width)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(parts: list[np.ndarray], kind=np.int64) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, kind), *parts])))


def shingle_rows(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """(rid, doc_id, n, key, short) for every row of docs (rid, doc_id, text): size, class of equal sets (null if empty)
    and bitmap; and how often each hash bucket of shingles occurs in all documents, counted in the same pass.
    """
    size = 1 << COUNTER_BITS

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            n, key = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            short, at = [np.zeros(0, np.int64)] * b.num_rows, [np.zeros(0, np.int64)]
            for i, s in _sets(b.column(2), k):
                n[i] = len(s)
                if len(s):
                    key[i], short[i] = _key(s), _bitmap(s)
                    at.append((s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64))
            total += np.bincount(np.concatenate(at), minlength=size)
            none = pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int64()), pa.array(n), pa.array(key, mask=n == 0), _lists(short), *none], names)
        if total.any():  # the task's counters, in parts, as rows of their own
            packed = [zlib.compress(x.tobytes(), 1) for x in np.split(total, PARTS)]
            empty = [pa.nulls(PARTS, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(range(PARTS), pa.int32()), pa.array(packed, pa.binary())], names)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in pdf["counts"])
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    names = ["rid", "doc_id", "n", "key", "short", "part", "counts"]
    rows = cut(docs.select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, n long, key long, short array<long>, part int, counts binary"))
    found = rows.where("part IS NOT NULL").select("part", "counts").groupBy("part").applyInPandas(add, "part int, counts binary").collect()  # 32 rows, 2 MB at most before packing
    out = np.zeros(size, np.int64)
    for r in found:
        out[r["part"] * (size // PARTS) : (r["part"] + 1) * (size // PARTS)] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    return rows.where("part IS NULL").drop("part", "counts"), out


def _prefixes(texts: DataFrame, k: int, percent: int, counts: np.ndarray, rounds: int = 1, at: int = 0) -> DataFrame:
    """(token, key, n, front, salt): for each text, one a class, the elements of its set of which any similar set shares one; of
    several rounds those of one.

    front marks those of which any similar set that is no smaller shares one.
    salt is 0 but for an element whose counter is so high that its rows would be too many for one task: those spread by
    class over as many salts as keep each near the common size.
    """
    mean = max(1.0, counts.mean())
    level = np.maximum(0, np.log2(np.maximum(counts, 1) / mean) - 0.5).astype(np.int8)
    salts = np.maximum(1, counts // int(max(HOT_ROWS, 4 * mean))).astype(np.int32)
    shared = texts.sparkSession.sparkContext.broadcast((level, salts))

    def run(batches):
        rank, spread = shared.value
        for b in batches:
            out = []
            for _, s in _sets(b.column(0), k):
                n = len(s)
                if 100 * n < percent * (n + 1):
                    continue  # so small that only equal sets are similar
                p = n - -(-percent * n // 100) + 1
                at_counter = (s >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                order = np.lexsort((s, rank[at_counter])) if p < n else np.arange(n)
                take, front = order[:p], np.arange(p) <= n - -(-2 * percent * n // (100 + percent))
                if rounds > 1:
                    mine = s[take] % np.uint64(rounds) == at
                    take, front = take[mine], front[mine]
                key, wide = _key(s), spread[at_counter[take]].astype(np.int64)
                out.append((s[take].astype(np.int64), np.full(len(take), key), np.full(len(take), n, np.int32), front, np.where(wide > 1, 1 + key % wide, 0).astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["token", "key", "n", "front", "salt"])

    return texts.select("text").mapInArrow(run, "token long, key long, n int, front boolean, salt int")


def _compressed(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _hook(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Roots (the least of each group) after the edges (u, v)."""
    while len(u):
        a, b = parent[u], parent[v]
        u, v, a, b = (x[a != b] for x in (u, v, a, b))
        if len(u):
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            parent = _compressed(parent)
    return parent


def _by_block(cols: list[str], passing):
    """passing(table) over whole blocks of rows that come sorted by cols; the last block of a batch waits for the next batch."""

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            last = np.ones(t.num_rows, bool)
            for c in cols:
                v = t[c].to_numpy()
                last &= v == v[-1]
            held = t.filter(pa.array(last))
            if not last.all():
                yield from passing(t.filter(pa.array(~last)))
        if held is not None:
            yield from passing(held)

    return run


def _forest(percent: int):
    """A spanning forest (a, b) of the candidates of different components within each block (or between two) of a tile.

    Rows come sorted by tile, block and size; a row with a front element meets the next row, then the one after it and so on,
    all tiles of a batch at once, until the sizes no longer fit. Rows that candidates join already are passed over.
    """
    cols = ["token", "band", "i", "j"]

    def passing(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, n, comp, part, own = (t[c].to_numpy() for c in ("key", "n", "comp", "part", "own"))
        across = t["i"].to_numpy() != t["j"].to_numpy()
        short = t["short"].combine_chunks()
        short = short.chunk(0) if isinstance(short, pa.ChunkedArray) else short
        wide, values = short.value_lengths().to_numpy(), short.flatten().to_numpy()
        ends = np.cumsum(wide)
        folded = {}
        for w in np.unique(wide):  # the bitmaps of this width and the wider ones folded to it: widths are powers of two, parities add by xor
            rows = np.flatnonzero(wide >= w)
            maps = np.zeros((len(rows), w), np.uint64)
            for has in np.unique(wide[rows]):
                some = np.flatnonzero(wide[rows] == has)
                words = values[(ends[rows[some]] - has)[:, None] + np.arange(has)]
                maps[some] = np.bitwise_xor.reduce(words.reshape(len(some), -1, w), axis=1).view(np.uint64)
            folded[w] = rows, maps
        same = np.zeros(len(key), np.int64)
        same[1:] = np.cumsum(np.any([np.diff(t[c].to_numpy()) != 0 for c in cols], axis=0))
        parent = np.arange(len(key))
        x, d = np.flatnonzero(t["front"].to_numpy()), 0
        while len(x):
            d += 1
            x = x[x + d < len(key)]
            y = x + d
            x = x[(same[x] == same[y]) & (percent * n[y] <= 100 * n[x])]
            y = x + d
            keep = (comp[x] != comp[y]) & (parent[x] != parent[y]) & (own[x] | own[y]) & (~across[x] | (part[x] != part[y]))
            u, v = x[keep], y[keep]
            differ, meet = np.zeros(len(u), np.int64), np.minimum(wide[u], wide[v])
            for w in np.unique(meet):
                at = meet == w
                rows, maps = folded[w]
                differ[at] = np.bitwise_count(maps[np.searchsorted(rows, u[at])] ^ maps[np.searchsorted(rows, v[at])]).sum(axis=1, dtype=np.int64)
            most = (n[u] + n[v] - differ) // 2  # no more elements can be shared
            ok = 100 * most >= percent * (n[u] + n[v] - most)
            parent = _hook(parent, u[ok], v[ok])
        child = np.flatnonzero(parent != np.arange(len(key)))
        pairs = np.unique(np.sort(np.stack([key[parent[child]], key[child]], 1), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return _by_block(cols, passing)


def _links(sets: list[np.ndarray], comp: np.ndarray, part: np.ndarray, across: bool, percent: int) -> np.ndarray:
    """A spanning forest of the similar pairs of a block, as (row, row): bit counts, then exact intersections.

    comp is what earlier links join, as numbers below the number of rows."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sets, comp, part = [sets[i] for i in order], comp[order].copy(), part[order]
    n = np.array([len(s) for s in sets])
    ends = np.cumsum(n)
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    maps = np.stack([_bitmap(s, 2 * _width(n[-1])) for s in sets]).view(np.uint64)
    mark = np.zeros(ids.max() + 1, np.int32)
    found = []
    for x in range(len(sets) - 1):
        y = np.arange(x + 1, np.searchsorted(n, 100 * n[x] // percent, "right"))
        y = y[comp[y] != comp[x]]
        if across:
            y = y[part[y] != part[x]]
        if not len(y):
            continue
        most = (n[x] + n[y] - np.bitwise_count(maps[x] ^ maps[y]).sum(axis=1, dtype=np.int64)) // 2
        y = y[100 * most >= percent * (n[x] + n[y] - most)]
        if not len(y):
            continue
        mine = ids[ends[x] - n[x] : ends[x]]
        mark[mine] = 1
        both = np.zeros(len(y), np.int64)
        for some in np.split(np.arange(len(y)), np.flatnonzero(np.diff(np.cumsum(n[y]) // (ELEMENTS // 4))) + 1):
            m = n[y[some]]
            at = np.cumsum(m) - m
            both[some] = np.add.reduceat(mark[ids[np.arange(m.sum()) + np.repeat(ends[y[some]] - m - at, m)]], at)
        mark[mine] = 0
        y = y[100 * both >= percent * (n[x] + n[y] - both)]
        new, first = np.unique(comp[y], return_index=True)
        if len(new):
            found += [(x, v) for v in y[first]]
            comp[np.isin(comp, new)] = comp[x]
    return order[np.array(found, np.int64).reshape(-1, 2)]


def _compared(k: int, percent: int):
    """Links (a, b) within each block of a family; rows (family, i, j, key, comp, part, text) come sorted by block."""
    cols = ["family", "i", "j"]

    def passing(t: pa.Table) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.any([np.diff(t[c].to_numpy()) != 0 for c in cols], axis=0)) + 1
        key, comp, part = (t[c].to_numpy() for c in ("key", "comp", "part"))
        out = [np.zeros((0, 2), np.int64)]
        for a, e in zip([0, *edge], [*edge, t.num_rows]):
            if e - a > 1:
                sets = [s for _, s in _sets(t["text"].slice(a, e - a), k)]
                joined = np.unique(comp[a:e], return_inverse=True)[1]
                out.append(key[a:e][_links(sets, joined, part[a:e], t["i"][int(a)].as_py() != t["j"][int(a)].as_py(), percent)])
        pairs = np.concatenate(out)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return _by_block(cols, passing)


def _shared(prefix: DataFrame, percent: int) -> DataFrame:
    """(token, key, n, front, band, own): the rows of the elements that two classes share, in the tiles that may hold a candidate.

    One shuffle finds both; rows that are salted all stay, and the tiles sort them out."""
    same = Window.partitionBy("token", "salt")
    prefix = prefix.withColumn("low", F.min("key").over(same)).withColumn("high", F.max("key").over(same)).withColumn("any", F.max("front").over(same))
    shared = prefix.where("low < high AND any OR salt > 0").dropDuplicates(["token", "salt", "key"])
    # each class stands in its own band and in the next, so that two bands that can match always meet in the larger's
    band = F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent))).cast("int")
    side = F.explode(F.array(*(F.struct((band + x).alias("band"), F.lit(x == 0).alias("own")) for x in (0, 1))))
    shared = shared.withColumn("side", side).select("token", "salt", "key", "n", "front", "side.band", "side.own")
    tile = Window.partitionBy("token", "salt", "band")
    least = F.min(F.when(F.col("front"), F.col("n"))).over(tile)
    shared = shared.withColumn("low", F.min("key").over(tile)).withColumn("high", F.max("key").over(tile)).withColumn("any", F.max("own").over(tile)).withColumn("least", least)
    return shared.where("salt > 0 OR low < high AND any AND least <= n").select("token", "key", "n", "front", "band", "own")


def _tiles(shared: DataFrame, big: DataFrame, classes: DataFrame, joined: DataFrame | None, rounds: int = 1, at: int = 0) -> DataFrame:
    """Rows of tiles with their bitmaps, in blocks (i, j) of bounded size, ready for _forest; of several rounds those of one."""
    rows = shared.join(small(big), ["token", "band"], "left")
    rows = rows.withColumn("blocks", F.coalesce(F.ceil(F.col("size") / F.lit(BLOCK)), F.lit(1)).cast("int")).withColumn("part", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j")))
    rows = rows.withColumn("pair", F.explode(pair)).select("token", "band", "key", "n", "front", "own", "part", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))
    block = ["token", "band", "i", "j"]
    if rounds > 1:
        rows = rows.where(F.pmod(F.xxhash64(*block), F.lit(rounds)) == at)
    rows = rows.join(classes.select("key", "short"), "key")
    if joined is None:
        rows = rows.withColumn("comp", F.col("key"))
    else:
        rows = rows.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    rows = rows.select("token", "band", "key", "n", "front", "own", "comp", "part", "short", "i", "j")
    return rows.repartition(*block).sortWithinPartitions(*block, "n", "key")


def _candidates(shared: DataFrame, classes: DataFrame, joined: DataFrame | None, percent: int) -> DataFrame:
    """(a, b): the spanning forests of all tiles, in as many rounds as their rows ask for."""
    big = cut(shared.groupBy("token", "band").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK))
    again = big.agg(F.sum(F.col("size") * (F.ceil(F.col("size") / F.lit(BLOCK)) - 1)).cast("long")).first()[0] or 0  # a row of a tile in blocks stands in each pair with its own
    rounds = max(1, -(-(shared.count() + again) // ROUND_TILES))
    return _union(cut(_tiles(shared, big, classes, joined, rounds, at).mapInArrow(_forest(percent), "a long, b long").distinct()) for at in range(rounds))


def _union(parts) -> DataFrame:
    return reduce(DataFrame.union, list(parts))


def _families(forest: DataFrame, classes: DataFrame) -> DataFrame:
    """(family, key, rep, n, blocks, part, lead): the classes that candidates join, and the block of each."""
    member = components(forest).select(F.col("comp").alias("family"), F.col("node").alias("key")).join(classes.select("key", "rep", "n"), "key")
    member = cut(member)
    size = member.groupBy("family").agg(F.count("*").alias("m"), F.sum("n").alias("elements"), F.min("key").alias("lead"))
    size = size.withColumn("blocks", F.greatest(F.ceil(F.col("m") / F.lit(BLOCK)), F.ceil(F.col("elements") / F.lit(ELEMENTS))).cast("int")).where("blocks > 1")
    member = member.join(small(cut(size)), "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return member.select("family", "key", "rep", "n", "blocks", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("part"), (F.col("key") == F.col("lead")).alias("lead"))


def _verified(member: DataFrame, docs: DataFrame, pair, k: int, percent: int) -> DataFrame:
    """Links of families whose rows stand in the blocks (i, j) of `pair`; member has their component in `comp`. In as many rounds as
    the elements of their sets ask for."""
    elements = member.agg(F.sum(F.col("n") * F.size(pair)).cast("long")).first()[0] or 0
    rounds = max(1, -(-elements // ROUND_ELEMENTS))
    block = ["family", "i", "j"]

    def links(at: int) -> DataFrame:
        mine = pair if rounds == 1 else F.filter(pair, lambda x: F.pmod(F.xxhash64("family", x["i"], x["j"]), F.lit(rounds)) == at)
        some = member.withColumn("pairs", mine).where(F.size("pairs") > 0)
        texts = among(docs.select(F.col("rid").alias("rep"), "text"), "rep", some.select("rep"))  # one text a class; the others stay where they are
        one = texts.join(small(some), "rep")
        one = one.withColumn("pair", F.explode("pairs")).select("family", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "key", "comp", "part", "text")
        return cut(one.repartition(*block).sortWithinPartitions(*block).mapInArrow(_compared(k, percent), "a long, b long"))

    return _union(map(links, range(rounds)))


def _grouped(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For docs (rid, doc_id, text), numbered(): rows (rid, doc_id, n, key) and (key, doc_id, copies, comp) of the classes."""
    rows, counts = shingle_rows(docs, k)
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("rid").alias("rep"), F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("short").alias("short"))
    classes = cut(classes)

    texts = among(docs.select("rid", "text"), "rid", classes.select(F.col("rep").alias("rid")))  # one a class
    taken = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    rounds = max(1, -(-int(classes.agg(F.sum(taken)).first()[0] or 0) // ROUND_PREFIXES))
    shared = _union([cut(_shared(_prefixes(texts, k, percent, counts, rounds, at), percent)) for at in range(rounds)])

    forest = _candidates(shared, classes, None, percent)
    member = cut(_families(forest, classes).withColumn("comp", F.col("key")))
    diagonal = F.when(F.col("lead"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(x.alias("i"), x.alias("j"))))
    diagonal = F.coalesce(diagonal, F.array(F.struct(F.col("part").alias("i"), F.col("part").alias("j"))))
    links = _verified(member, docs, diagonal, k, percent)
    joined = components(links)
    if member.where("blocks > 1").limit(1).count():
        # of the families in several blocks, what still has candidates in other components, each pair of blocks
        wide = cut(member.where("blocks > 1").select("key"))
        open_ = cut(shared.join(small(wide), "key", "left_semi").select(*shared.columns))
        again = _candidates(open_, classes, joined, percent)
        rest = _families(again, classes).join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
        every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("part")).alias("i"), F.greatest(x, F.col("part")).alias("j")))
        more = _verified(cut(rest), docs, every, k, percent)
        joined = components(links.union(more))
        release(wide, open_, again, more)
    release(shared, forest, member, links)
    named = classes.select("key", "doc_id", "copies").join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return rows.select("rid", "doc_id", "n", "key"), cut(named)


def _by_class(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows with the columns of named by key; the rows of classes with very many copies meet theirs by broadcast."""
    hot = named.where(F.col("copies") > HOT_ROWS)
    if not hot.limit(1).count():
        return rows.join(named, "key", "left")
    hot = small(cut(hot))
    cold = rows.join(hot.select("key"), "key", "left_anti").join(named.where(F.col("copies") <= HOT_ROWS), "key", "left")
    return cold.unionByName(rows.join(hot, "key"))


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, stored: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text).

    n_shingles is the size of the set of distinct k-word shingles of the text with A-Z lower-cased; with fewer
    words all of them are one shingle. component_id is the smallest doc_id that links (100 * intersection >=
    percent * union) reach, itself included. A null, empty or wordless text has size 0, links with nothing and is its own
    component. Rows that repeat a doc_id, or have none, are documents of their own. Other columns of docs are not read.
    stored: docs is the rows of a table's files as they are, of which no copy is needed.
    """
    rows, named = _grouped(numbered(docs.select("doc_id", "text"), "rid", stored), k, percent)
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = cut(named.join(least, "comp").select("key", "copies", "component_id"))
    out = _by_class(rows, named)
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, k: int = 4, percent: int = 85, stored: bool = False) -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest doc_id (a null one counts last), the first of several.

    Rows are told apart by their place, not by doc_id. Texts without words are copies of nothing and stay.
    stored: docs is the rows of a table's files as they are, of which no copy is needed.
    """
    tagged = numbered(docs, "__rid", stored)
    rows, named = _grouped(tagged.select(F.col("__rid").alias("rid"), "doc_id", "text"), k, percent)
    at = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    # copies combine before the shuffle, first by class, then by component
    best = rows.where("key IS NOT NULL").groupBy("key").agg(F.min(at).alias("at")).join(named.select("key", "comp"), "key").groupBy("comp").agg(F.min("at").alias("at"))
    stay = cut(best.select(F.col("at.rid").alias("__rid")))
    bare = rows.where("key IS NULL").select(F.col("rid").alias("__rid"))
    return among(tagged, "__rid", cut(stay.union(bare))).select(*docs.columns)
