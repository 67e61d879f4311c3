"""Periodic runs of words: maximal pairs of a document's suffixes.

A run of period q that starts at word i is the pair of suffixes i and i + q: they agree for the run's length less q (their
longest common prefix), and their left words differ, or the run would start earlier. So each node of the tree of LCP intervals,
built bottom-up, lists the places of its suffixes, each with its left word as class; two neighbours in that list from
different children and of different classes, no farther apart than the node's LCP, are one run, with its smallest period: a smaller one would
put another place of the same words between them. Nothing is extended and nothing found twice. Lists merge small
into large, and a list of one class is not looked into: it holds no maximal pair.

A run of 12 words or more agrees with itself for six at least, so suffixes are sorted only for documents in which six words
come again after another left word, and the tree begins at six words.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that are looked at together; a longer document is alone.
CHUNK = 1 << 18
_PLACE = np.random.default_rng(20_13).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def suffix_order(w: np.ndarray) -> np.ndarray:
    """The places of w, sorted by the suffixes that start there. w ends with a value found nowhere else.

    Ranks by the first 1, 2, 4, ... words; a rank is the place of its first holder, so what is settled stays.
    """
    n = len(w)
    order = np.argsort(w, kind="stable")
    new = np.ones(n, bool)
    new[1:] = w[order[1:]] != w[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    size = 1
    while True:
        count = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(count[rank] > 1)
        if not len(open_):
            break
        key = rank[open_] * (n + 1) + rank[np.minimum(open_ + size, n - 1)]
        by = np.argsort(key, kind="stable")
        at, key = open_[by], key[by]
        first = np.ones(len(at), bool)
        first[1:] = rank[at[1:]] != rank[at[:-1]]  # of a rank
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]  # of a finer rank
        i = np.arange(len(at))
        rank[at] += np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(first, i, 0))
        size *= 2
    return np.argsort(rank, kind="stable")


def _common(w: np.ndarray, i: int, j: int) -> int:
    """How many words the suffixes i < j share."""
    n, size = 0, 16
    while True:
        a, b = w[i + n : i + n + size], w[j + n : j + n + size]
        different = np.flatnonzero(a[: len(b)] != b)
        if len(different):
            return n + int(different[0])
        n += len(b)
        if len(b) < size:
            return n
        size *= 4


def common_prefixes(w: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The LCP of each suffix of order with the one before it (0 for the first).

    Behind equal left words it is one less than at the place before, if that stands in order as well; only the others are compared.
    """
    lcp = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return lcp
    a, b = order[:-1], order[1:]
    by_place = np.full(len(w), -1, np.int64)
    partner = np.full(len(w), -1, np.int64)
    partner[b] = a
    inner = (a > 0) & (b > 0)
    inner[inner] = (w[a[inner] - 1] == w[b[inner] - 1]) & (partner[b[inner] - 1] == a[inner] - 1)
    for i, j in zip(a[~inner].tolist(), b[~inner].tolist()):
        by_place[j] = _common(w, min(i, j), max(i, j))
    place = np.arange(len(w))
    last = np.maximum.accumulate(np.where(by_place >= 0, place, 0))
    lcp[1:] = by_place[last[b]] - (b - last[b])
    return lcp


def maximal_pairs(order: list[int], lcp: list[int], left: list[int], least: int, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among suffixes in order, whose neighbours share lcp words.

    An interval is [lcp, list of places in order, class or None if they have several, lists of its lesser children].
    """
    out = []

    def joined(node: list, places: list[int], kind) -> None:
        """Takes a child in: the largest one's list is kept, the others wait for the interval's end."""
        if len(places) > len(node[1]):
            node[1], places = places, node[1]
        if places:
            node[3].append(places)
        node[2] = kind if node[2] == () or node[2] == kind else None

    def closed(node: list) -> tuple[list[int], object]:
        depth, all_, kind, lesser = node
        rest = [x for p in lesser for x in p]
        child = {x: k for k, p in enumerate(lesser) for x in p} if kind is None else {}
        if len(rest) * 8 > len(all_):
            all_ = sorted(all_ + rest)
        else:
            for x in rest:
                bisect.insort(all_, x)
        for x in rest if kind is None else ():
            k = bisect.bisect_left(all_, x)
            for i, j in ((all_[k - 1], x) if k else (x, x), (x, all_[k + 1]) if k + 1 < len(all_) else (x, x)):
                # of two lesser children's places the later one reports the pair
                if 0 < j - i <= depth and j - i + depth >= shortest and left[i] != left[j] and child.get(i) != child.get(j) and (j == x or i not in child or j not in child):
                    out.append((i, j - i + depth, j - i))
        return all_, kind

    stack = [[least - 1, [], (), []]]
    for k in range(1, len(order) + 1):
        depth = lcp[k] if k < len(order) and lcp[k] >= least else least - 1
        place, kind = [order[k - 1]], left[order[k - 1]]
        if depth > stack[-1][0]:  # the suffix belongs to the interval that it opens with its next
            stack.append([depth, place, kind, []])
            continue
        joined(stack[-1], place, kind) if stack[-1][0] >= least else None
        while stack[-1][0] > depth:
            places, kind = closed(stack.pop())
            if depth > stack[-1][0]:
                stack.append([depth, places, kind, []])
            elif stack[-1][0] >= least:
                joined(stack[-1], places, kind)
    return out


def runs_of(texts: list[list], shortest: int = 12) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period; in that order) of each list of words, of `shortest` words or more and twice their period."""
    least = (shortest + 1) // 2
    out: list[list] = [[] for _ in texts]
    number: dict = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    ids = np.array([number.setdefault(x, len(number)) for t in texts for x in t], np.int64)
    if len(ids) < shortest:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum([0, *sizes])
    # places whose next `least` words occur again in their document (by hash: some may not)
    n = len(ids) - least + 1
    h = doc[:n].astype(np.uint64) * _PLACE[least]
    for j in range(least):
        h = h + (ids[j : j + n].astype(np.uint64) + np.uint64(1)) * _PLACE[j]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:n] == doc[least - 1 :])
    order = inside[np.argsort(h[inside], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    left = np.where(np.arange(len(ids)) == begins[doc], -1, np.concatenate([[-1], ids[:-1]]))  # a text's first word has no left word
    mixed = np.flatnonzero(same & (left[order[1:]] != left[order[:-1]]))
    for d in np.unique(doc[order[mixed]]).tolist():
        out[d] = _runs(ids[begins[d] : begins[d + 1]], least, shortest)
    return out


def _runs(ids: np.ndarray, least: int, shortest: int) -> list[tuple[int, int, int]]:
    w = np.append(np.unique(ids, return_inverse=True)[1], len(ids) + 1)
    order = suffix_order(w)
    lcp = common_prefixes(w, order)
    left = np.concatenate([[-1], w[:-1]])
    # stretches of suffixes that share `least` words, after more than one left word
    begins = np.flatnonzero(lcp < least)
    ends = np.append(begins[1:], len(order))
    classes = left[order]
    lists = left.tolist()
    found = []
    low, high = np.minimum.reduceat(classes, begins), np.maximum.reduceat(classes, begins)
    for a, b in zip(begins[low < high].tolist(), ends[low < high].tolist()):
        found += maximal_pairs(order[a:b].tolist(), lcp[a:b].tolist(), lists, least, shortest)
    return sorted((s, n, q) for s, n, q in found)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Which of n words no run holds after its first period; None: all."""
    if not runs:
        return None
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _chunks(rows: Iterator[tuple[object, list]]) -> Iterator[list]:
    got, size = [], 0
    for r in rows:
        if got and size + len(r[1]) > CHUNK:
            yield got
            got, size = [], 0
        got.append(r)
        size += len(r[1])
    if got:
        yield got


def periodic_runs(docs: DataFrame, shortest: int = 12, prepare: Callable[[object, list], list] | None = None) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start,length,period>>, collapsed), a row for each row of docs; no shuffle.

    Words stand between white space (space, U+0009 to U+000D). A run is a stretch of at least `shortest` words and twice its
    smallest period that neither neighbour extends; collapsed is the text without the words that a run repeats, joined by
    a space. Null, empty and blank texts have no words and no runs. prepare(doc_id, words) may change a row's words beforehand.
    """

    def run(batches):
        for b in batches:
            texts = zip(b.column(0).to_pylist(), b.column(1))
            words = ((i, (t.as_py() or "").encode("utf-8", "surrogatepass").split()) for i, t in texts)
            for chunk in _chunks((i, prepare(i, w) if prepare and w else w) for i, w in words):
                runs, left = runs_of([w for _, w in chunk], shortest), []
                for (_, w), r in zip(chunk, runs):
                    keep = kept_words(len(w), r)
                    left.append(b" ".join(w if keep is None else [x for x, k in zip(w, keep.tolist()) if k]).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in chunk], b.column(0).type), pa.array([len(w) for _, w in chunk], pa.int64()), pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in runs], _RUNS), pa.array(left, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def run_digest(found: DataFrame) -> DataFrame:
    """periodic_runs' rows as numbers and hashes: how many runs, the longest (ties: the first, then the shorter period), all of them."""
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.array_min(order).alias("top"), F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return best.select("doc_id", "n_runs", "top.start", "top.length", "top.period", F.expr("1000 * top.length div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
