"""Benchmark decontamination by winnowing.

Every window of ten words keeps the least hash of its six-word grams. A window that stands in a test item and in a document
has the same fingerprint in both, so a join of fingerprints meets every shared span of ten words; the span's
words, carried beside the fingerprint, are part of the join's key and decide. Which documents' fingerprints are worth sending
is told by a bitmap of the items' fingerprints: 2**27 bits whatever the items number, so its broadcast has a bound of 16 MB.

Items of fewer words are one window each; for those lengths alone every gram of that many words is its own fingerprint.
Windows, not items, meet documents, and documents with the same set of windows share one list of items: neither a
passage of a third of all documents nor a window of a third of all items makes pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

#: log2 of the bits of the map of item fingerprints.
BITS = 27
#: Bytes of text hashed at once, and windows looked at once.
BLOCK, SLICE = 1 << 20, 1 << 18

_RNG = np.random.default_rng(20_11)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 2**63)) | 1
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers modulo 2**64 and their inverses, n of each at least."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    if size not in _POWERS:
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[size] = both[0], both[1]
    return _POWERS[size]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def hashed_words(low: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of each word of lower-cased UTF-8: runs of digits, a-z and bytes from 0x80 on."""
    buf = np.frombuffer(low, np.uint8)
    parts, at = [], 0
    while at < len(buf):
        stop = min(at + BLOCK, len(buf))
        while stop < len(buf) and _IN_WORD[buf[stop]]:  # a block ends between words
            stop += 1
        part = buf[at:stop]
        edge = np.diff(_IN_WORD[part].astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
        parts.append((first + at, last + at, _mixed((total[last] - total[first]) * down[first])))
        at = stop
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def fingerprints(h: np.ndarray, m: int, k: int) -> np.ndarray:
    """Of each window of m consecutive word hashes, the least hash of its grams of k words."""
    n = len(h) - k + 1
    gram = np.full(n, k, np.uint64)
    for j in range(k):
        gram += h[j : j + n] * _PLACE[j]
    gram = _mixed(gram)
    least = gram[: n - (m - k)]
    for j in range(1, m - k + 1):
        least = np.minimum(least, gram[j : j + len(least)])
    return least


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, lower-cased texts) of some BLOCK bytes together; a long text is alone."""
    got, size, first = [], 0, 0
    for k, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z alone
        if got and size + len(b) > BLOCK:
            yield first, got
            got, size, first = [], 0, k
        got.append(b)
        size += len(b)
    if got:
        yield first, got


def _shared_windows(texts: list[str | None], lengths: list[tuple[int, int]], wanted) -> Iterator[tuple[int, int, dict]]:
    """(number, words, {(fingerprint, length, window): word numbers}) of each text, for windows whose fingerprint is wanted.

    lengths: (window, gram) in words. wanted(fingerprints) gives a mask, or None takes windows of the one length that the text's
    own number of words asks for (an item's).
    """
    for first, some in _chunks(texts):
        low = b" ".join(some)
        start, end, h = hashed_words(low)
        begins = np.cumsum([0, *(len(b) + 1 for b in some)])
        doc = np.searchsorted(begins, start, "right") - 1
        n = np.bincount(doc, minlength=len(some))
        before = np.cumsum([0, *n])
        found: list[dict] = [defaultdict(list) for _ in some]
        for m, k in lengths:
            for at in range(0, len(h) - m + 1, SLICE):
                fp = fingerprints(h[at : at + SLICE + m - 1], m, k)
                d = doc[at : at + len(fp)]
                good = d == doc[at + m - 1 : at + m - 1 + len(fp)]
                good &= wanted(fp) if wanted else (n[d] == m) | ((n[d] > m) & (m == lengths[0][0]))
                for i in np.flatnonzero(good):
                    g = at + int(i)
                    words = b" ".join([low[a:b] for a, b in zip(start[g : g + m], end[g : g + m])])
                    x = int(doc[g])
                    found[x][int(fp[i]), m, words].append(g - int(before[x]))
        for x in range(len(some)):
            yield first + x, int(n[x]), found[x]


_WINDOW = pa.list_(pa.struct([("fp", pa.int64()), ("m", pa.int32()), ("words", pa.string()), ("starts", pa.list_(pa.int32()))]))


def _listed(found: dict) -> list[dict]:
    return [{"fp": fp - (fp >> 63 << 64), "m": m, "words": w.decode("utf-8", "replace"), "starts": at} for (fp, m, w), at in found.items()]


def item_windows(items: DataFrame, window: int = 10, gram: int = 6) -> DataFrame:
    """(item_id, fp, m, words): each different window of each item; an item of fewer words, but not none, is one window."""
    lengths = [(window, gram), *((m, m) for m in range(1, window))]

    def run(batches):
        for b in batches:
            got = [x for _, _, f in _shared_windows(b.column(1).to_pylist(), lengths, None) for x in [_listed(f)]]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, _WINDOW)], ["item_id", "w"])

    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(run, "item_id string, w array<struct<fp:bigint,m:int,words:string,starts:array<int>>>")
    return rows.select("item_id", F.inline("w")).drop("starts").distinct()


def _bitmap(windows: DataFrame) -> np.ndarray:
    """2**BITS bits with those of the windows' fingerprints set: at most 2**(BITS-6) numbers reach the driver."""
    bit = F.shiftrightunsigned("fp", 64 - BITS)
    # 1 << n, as a column: shiftleft takes a literal count only
    one = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(fp, {64 - BITS}) & 63 AS INT))")
    got = windows.groupBy(F.shiftrightunsigned(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toPandas()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[got["at"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _covered(spans: Column) -> Column:
    """How many words spans (start, m) cover together."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        end = x["start"].cast("long") + x["m"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["start"].cast("long")))).alias("n"))

    return F.aggregate(F.sort_array(spans), zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 6) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated), a row for each row of docs.

    A word of a document is hit if it lies in an occurrence of a window of some item; items lists the ids of the items with a
    window in the document, as strings in order. Null and empty texts have no words and no hits, as have items without words. Items
    with one id count once; an item without an id hits words but is not listed. Rows that repeat are told apart.
    """
    spark = docs.sparkSession
    of_items = cut(item_windows(items, window, gram))
    windows = cut(of_items.select("fp", "m", "words").distinct().withColumn("wid", F.monotonically_increasing_id()))
    lengths = [(m, gram if m == window else m) for (m,) in windows.select("m").distinct().collect()]  # window numbers at most
    known = spark.sparkContext.broadcast(_bitmap(windows))

    def run(batches):
        bits = known.value

        def wanted(fp: np.ndarray) -> np.ndarray:
            bit = fp >> np.uint64(64 - BITS)
            return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

        for b in batches:
            got = [(n, _listed(f)) for _, n, f in _shared_windows(b.column(2).to_pylist(), lengths, wanted)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([n for n, _ in got], pa.int64()), pa.array([x for _, x in got], _WINDOW)], ["row", "doc_id", "n_words", "w"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    seen = cut(seen.mapInArrow(run, f"row long, doc_id {kind}, n_words long, w array<struct<fp:bigint,m:int,words:string,starts:array<int>>>"))

    hits = seen.select("row", F.inline("w")).join(small(windows), ["fp", "m", "words"]).select("row", "wid", "m", "starts")
    spans = F.flatten(F.collect_list(F.transform("starts", lambda s: F.struct(s.alias("start"), F.col("m").alias("m")))))
    per = hits.groupBy("row").agg(F.sort_array(F.collect_set("wid")).alias("wids"), _covered(spans).alias("n_hit"))
    per = cut(per.withColumn("set", F.sha2(F.array_join("wids", ","), 256)))
    sets = per.select("set", "wids").dropDuplicates(["set"]).select("set", F.explode("wids").alias("wid"))
    ids = of_items.where("item_id IS NOT NULL").join(windows, ["fp", "m", "words"]).select("wid", "item_id")
    lists = sets.join(ids, "wid").select("set", "item_id").distinct().groupBy("set").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    lists = lists.select("set", "items", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    per = per.select("row", "n_hit", "set").join(lists, "set", "left").drop("set")
    out = seen.select("row", "doc_id", "n_words").join(per, "row", "left")
    zero = F.lit(0).cast("long")
    none = F.sha2(F.lit(""), 256)
    return out.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("items_sha256", none).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))
