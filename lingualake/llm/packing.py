"""Best-fit packing of token sequences with large-item matching.

Every document is tokenized once, in Arrow batches. The packing itself needs the lengths alone, and of them only how
often each occurs: a table of at most `capacity` numbers at any corpus size. Items above a third of the capacity
are matched, at most two to a sequence, each largest one with the largest that still fits; the smaller ones then go,
largest first, to the fullest sequences with room. The outcome is a list of groups of equal sequences; pieces of one
length are numbered on Spark (in runs of bounded size, as many as the length's count asks) and look their place up in that list.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut

#: Pieces of one length that are numbered together; a more frequent length has more runs.
RUN = 250_000
#: Longer texts go to the tokenizer whose time does not depend on the length of a run of white space.
LONG_TEXT = 1_000_000
_LOADED: dict = {}


def _encoder(path: str):
    if path not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        special = sorted({x.content for x in t.get_added_tokens_decoder().values()})
        fast = None
        ranks = path.replace(".json", ".tiktoken")
        if ranks != path and os.path.exists(ranks):  # the same vocabulary as ranks: the same ids, some four times faster
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})

        def encode(text: str) -> list[int]:
            # texts that spell a special token go to the tokenizer itself, which takes it for that token
            if fast is not None and len(text) <= LONG_TEXT and not any(x in text for x in special):
                return fast.encode_ordinary(text)
            return t.encode(text, add_special_tokens=False).ids

        _LOADED[path] = encode
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each row's ids and the end id, cut after the first length % capacity."""

    def run(batches):
        encode = _encoder(path)
        for b in batches:
            out: dict[str, list] = defaultdict(list)
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : first if k == 0 else start + capacity]
                    for name, v in (("doc_id", doc_id), ("piece", k), ("start", start), ("length", len(part)), ("ids_crc32", zlib.crc32(part.tobytes()))):
                        out[name].append(v)
            types = {"doc_id": pa.int64(), "piece": pa.int32()}
            yield pa.RecordBatch.from_arrays([pa.array(out[c], types.get(c, pa.int64())) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Groups (lengths of a sequence's items in order, number of such sequences) that hold every item once."""
    left = {n: c for n, c in counts.items() if c}
    groups: list[tuple[tuple[int, ...], int]] = []
    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        at = bisect.bisect_right(large, capacity - n) - 1
        if at < 0:
            groups.append(((n,), left.pop(n)))
            large.pop()
            continue
        m = large[at]
        if m == n:
            pairs, odd = divmod(left.pop(n), 2)
            large.pop()
            groups += [((n, n), pairs)] * bool(pairs)
            if odd:
                rest = bisect.bisect_right(large, capacity - n) - 1
                if rest >= 0:
                    m = large[rest]
                    groups.append(((n, m), 1))
                    left[m] -= 1
                    if not left[m]:
                        left.pop(m), large.pop(rest)
                else:
                    groups.append(((n,), 1))
            continue
        k = min(left[n], left[m])
        groups.append(((n, m), k))
        for v in (n, m):
            left[v] -= k
            if not left[v]:
                left.pop(v)
                large.remove(v)
    gaps: dict[int, list] = defaultdict(list)
    for items, k in groups:
        gaps[capacity - sum(items)].append((items, k))
    keys = sorted(gaps)
    for n in sorted(left, reverse=True):
        while left[n]:
            at = bisect.bisect_left(keys, n)
            if at == len(keys):  # no room anywhere: new sequences, filled with this length
                per = capacity // n
                full, over = divmod(left[n], per)
                for items, k in (((n,) * per, full), ((n,) * over, 1 if over else 0)):
                    if k:
                        gap = capacity - sum(items)
                        gaps[gap].append((items, k))
                        if gap not in keys:
                            bisect.insort(keys, gap)
                left[n] = 0
                break
            gap = keys[at]
            items, k = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                keys.pop(at)
            fit = min(k, left[n])
            for x, c in ((items, k - fit), (items + (n,), fit)):
                if c:
                    g = capacity - sum(x)
                    gaps[g].append((x, c))
                    if g not in keys:
                        bisect.insort(keys, g)
            left[n] -= fit
    return [x for g in sorted(gaps) for x in gaps[g]]


def _places(groups) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence and offset of each slot, by rank."""
    rows, rank, seq = defaultdict(list), defaultdict(int), 0
    for items, k in groups:
        offset = 0
        for n in items:
            rows[n].append((rank[n], seq, offset))
            rank[n] += k
            offset += n
        seq += k
    return {n: tuple(np.array(c, np.int64) for c in zip(*x)) for n, x in rows.items()}


def pack(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): one row for each piece of each row of docs.

    Null and empty texts are the end id alone. Rows that repeat are packed as often as they occur. Only documents longer
    than the capacity are cut: the first piece takes what is over, the others are full. Same rows, same sequences.
    """
    cutted = cut(pieces(docs, path, capacity))
    total = {r["length"]: r["n"] for r in cutted.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    # runs of the lengths that need more than one: one row each for every RUN pieces, in a literal of at most capacity entries
    runs = [F.lit(x) for n, c in sorted(total.items()) if c > RUN for x in (n, -(-c // RUN))]
    of = F.coalesce(F.element_at(F.create_map(*runs), F.col("length")), F.lit(1)) if runs else F.lit(1)
    cutted = cutted.withColumn("run", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), of).cast("int"))
    counts = cutted.groupBy("length", "run").agg(F.count("*").alias("n")).collect() if runs else []  # capacity rows and one more for every RUN pieces
    before, at = {}, defaultdict(int)
    for r in sorted(counts, key=lambda r: (r["length"], r["run"])):
        before[r["length"], r["run"]] = at[r["length"]]
        at[r["length"]] += r["n"]
    shared = docs.sparkSession.sparkContext.broadcast((before, _places(pack_lengths(total, capacity))))
    order = W.partitionBy("length", "run").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cutted.withColumn("rank", F.row_number().over(order))

    def place(batches):
        first, places = shared.value
        for b in batches:
            length, run, rank = (b.column(i).to_numpy().astype(np.int64) for i in (3, 5, 6))
            seq, off = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            order = np.lexsort((run, length))
            edge = np.flatnonzero((np.diff(length[order]) != 0) | (np.diff(run[order]) != 0)) + 1
            for rows in np.split(order, edge) if b.num_rows else []:
                n = int(length[rows[0]])
                starts, seqs, offs = places[n]
                at = first.get((n, int(run[rows[0]])), 0) + rank[rows] - 1
                i = np.searchsorted(starts, at, "right") - 1
                seq[rows], off[rows] = seqs[i] + at - starts[i], offs[i]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seq), pa.array(off)], [*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "run", "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
