"""Cross-tokenizer alignment by products of sparse incidence matrices.

Tokens of a text are rows, its bytes (or groups) columns. With A and B the token-byte matrices of two tokenizers in CSR form,
A·Bᵀ has an entry for each pair of tokens whose bytes overlap; with their token-group matrices it has one for each pair that
shares a group. Products go row by row (Gustavson): each entry of a row of A brings in a row of the right matrix, and equal columns add up.

How many documents hold a pair of ids linked is a count over the corpus. Documents are worked in chunks; a chunk names each of its
pairs once, in a dictionary, and its documents hold numbers of that dictionary. Dictionaries alone are counted and looked up, so
a pair of nearly every document is a row a chunk, not a row a document. The counts then come back to each chunk's documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A chunk ends with so many tokens or documents.
TOKENS, DOCS = 1 << 20, 5000
#: Texts that are encoded in one call.
TOGETHER = 32
#: Longer texts go to the tokenizer whose time does not depend on the length of a run of white space.
LONG_TEXT = 1_000_000
#: Entries that a product expands at once.
ENTRIES = 1 << 20
#: A pair is one number: the A id, and the B id in the lower bits.
SHIFT = 20
_LOADED: dict = {}


class Csr:
    """A sparse 0/1 matrix by rows: row r holds the columns indices[indptr[r]:indptr[r + 1]]."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, columns: int):
        self.indptr, self.indices, self.columns = indptr, indices, columns

    @classmethod
    def of_intervals(cls, ends: np.ndarray) -> Csr:
        """Row r holds the columns from ends[r - 1] up to ends[r]."""
        n = int(ends[-1]) if len(ends) else 0
        return cls(np.concatenate([[0], ends]), np.arange(n), n)

    @classmethod
    def of_labels(cls, labels: np.ndarray, columns: int) -> Csr:
        """Row r holds the one column labels[r]."""
        return cls(np.arange(len(labels) + 1), labels, columns)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        if np.any(self.indices[1:] < self.indices[:-1]):
            rows = rows[np.argsort(self.indices, kind="stable")]
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))]), rows, len(self.indptr) - 1)


def gustavson(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """a·b in blocks of whole rows: (row, column, value) of the entries, by row, then column.

    A block expands some ENTRIES entries; a row that alone has more is a block of its own.
    """
    width = np.diff(b.indptr)
    work = np.concatenate([[0], np.cumsum(width[a.indices])])  # entries expanded before each entry of a
    before = work[a.indptr]
    r, rows = 0, len(a.indptr) - 1
    while r < rows:
        stop = max(r + 1, int(np.searchsorted(before, before[r] + ENTRIES, "right")) - 1)
        inner = a.indices[a.indptr[r] : a.indptr[stop]]
        n = width[inner]
        total = int(before[stop] - before[r])
        if total:
            row = np.repeat(np.arange(r, stop), np.diff(before[r : stop + 1]))
            begin = b.indptr[inner]
            at = begin if total == len(inner) and n.min() == 1 else np.arange(total) + np.repeat(begin - (np.cumsum(n) - n), n)
            key = row * b.columns + b.indices[at]
            if np.any(key[1:] < key[:-1]):
                key.sort()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            yield row[first], key[first] - row[first] * b.columns, np.diff(np.append(first, total))
        r = stop


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, bytes shared) of all pairs of tokens that share any byte; tokens are given by where they end."""
    parts = list(gustavson(Csr.of_intervals(ends_a), Csr.of_intervals(ends_b).transposed()))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each A and of each B token, and the number of groups: they end where tokens of both end."""
    at = np.searchsorted(ends_a, ends_b)
    last_b = ends_a[np.minimum(at, len(ends_a) - 1)] == ends_b
    last_a = np.zeros(len(ends_a), np.int64)
    last_a[at[last_b]] = 1
    return np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b, int(last_a.sum())


def shared_group_links(ga: np.ndarray, gb: np.ndarray, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(A token, B token, 1) of all pairs of tokens in one group, in blocks."""
    return gustavson(Csr.of_labels(ga, groups), Csr.of_labels(gb, groups).transposed())


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Encodes a list of texts to lists of ids, and joins the bytes of ids; token r spells pieces[r], of size[r] bytes."""

    def __init__(self, pieces: list[bytes], encode, join=None):
        self.pieces, self.encode = pieces, encode
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.join = join or (lambda ids: b"".join([pieces[k] for k in ids]))


def byte_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE of a tokenizer file, for a space and the text; special strings are plain text.

    Where the same vocabulary lies beside it as ranks, ids come from those, some four times faster.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    special = {k: x.content.encode() for k, x in t.get_added_tokens_decoder().items()}
    back = _byte_level()
    pieces = [special[k] if k in special else bytes(back[c] for c in t.id_to_token(k)) for k in range(t.get_vocab_size())]
    ranks, fast = path.replace(".json", ".tiktoken"), None
    if ranks != path and os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})

    def encode(text: str) -> list[int]:
        return fast.encode_ordinary(" " + text) if fast is not None and len(text) <= LONG_TEXT else t.encode(" " + text, add_special_tokens=False).ids

    return Vocabulary(pieces, lambda texts: map(encode, texts), fast and fast.decode_bytes)


def piece_vocabulary(path: str) -> Vocabulary:
    """A sentence-piece model that puts a space before the text itself; U+2581 is a space, <0xHH> a byte."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [bytes([int(p[3:5], 16)]) if m.is_byte(k) else p.replace("▁", " ").encode() for k in range(m.get_piece_size()) for p in [m.id_to_piece(k)]]
    return Vocabulary(pieces, lambda texts: m.encode(texts, num_threads=1))


def _vocabularies(path_a: str, path_b: str) -> tuple[Vocabulary, Vocabulary, np.ndarray]:
    """Both, and what each id reads in a digest: A before another A and before B, B before another B and before a new group."""
    if (path_a, path_b) not in _LOADED:
        a, b = byte_vocabulary(path_a), piece_vocabulary(path_b)
        text = [f"{k}{c}" for v, marks in ((a, ",|"), (b, ",;")) for c in marks for k in range(len(v.pieces))]
        _LOADED[path_a, path_b] = a, b, np.array(text, object)
    return _LOADED[path_a, path_b]


def _digests(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, text: np.ndarray, sizes: tuple[int, int], ends: np.ndarray) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of id sequences by group, hashed for each document; ends: of the documents, in tokens of both kinds."""
    last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
    code = np.empty(len(a) + len(b), np.int64)
    # before an A token stand the B tokens of the groups before; before a B token the A tokens up to its group's end
    upto_a, upto_b = (np.cumsum(np.bincount(g)) for g in (ga, gb))
    code[np.arange(len(a)) + np.append(0, upto_b)[ga]] = a + sizes[0] * last_a
    code[np.arange(len(b)) + upto_a[gb]] = 2 * sizes[0] + b + sizes[1] * last_b
    parts = (text[code[x:y]].tolist() for x, y in zip([0, *ends], ends))
    return [hashlib.sha256("".join(p)[:-1].encode()).hexdigest() if p else "" for p in parts]


def _encoded(texts: list[str | None], a: Vocabulary, b: Vocabulary) -> Iterator[tuple[list, list]]:
    """Both id sequences of each text; none if it is empty or one of them does not spell a space and the text."""
    for text, x, y in zip(texts, *(v.encode([t or "" for t in texts]) for v in (a, b))):
        want = b" " + (text or "").encode("utf-8", "surrogatepass")
        yield (x, y) if text and a.join(x) == want and b.join(y) == want else ([], [])


_DOC = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string"
_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]


def _linked(ids: list[tuple[list, list]], a: Vocabulary, b: Vocabulary, text: np.ndarray) -> list:
    """Arrays over the documents of a chunk (n_a, n_b, n_groups, n_links, n_shared, digest), then, of their different pairs: document,
    pair, times. The documents' bytes follow each other, so one product serves them all."""
    (x, y), n = ([np.array([k for d in ids for k in d[side]], np.int64) for side in (0, 1)], len(ids))
    ends_x, ends_y = np.cumsum(a.size[x]), np.cumsum(b.size[y])
    counts = [np.array([len(d[side]) for d in ids], np.int64) for side in (0, 1)]
    doc_x, doc_y = (np.repeat(np.arange(n), c) for c in counts)
    zero = np.zeros(n, np.int64)
    if not len(x):
        return [*counts, zero, zero, zero, [""] * n, *[np.zeros(0, np.int64)] * 3]
    i, j, _ = overlap_links(ends_x, ends_y)
    gx, gy, groups = group_labels(ends_x, ends_y)
    last = np.flatnonzero(np.append(gx[1:] != gx[:-1], True))
    shared = zero.copy()
    for rows, _, _ in shared_group_links(gx, gy, groups):
        shared += np.bincount(doc_x[rows], minlength=n)
    digests = _digests(x, y, gx, gy, text, (len(a.pieces), len(b.pieces)), np.cumsum(counts[0] + counts[1]))
    keys, number = np.unique((x[i] << SHIFT) | y[j], return_inverse=True)
    pair, times = np.unique(doc_x[i] * len(keys) + number, return_counts=True)
    return [*counts, np.bincount(doc_x[last], minlength=n), np.bincount(doc_x[i], minlength=n), shared, digests, pair // len(keys), keys[pair % len(keys)], times]


def _chunked(batches, path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """A row for each document and one for each chunk; pairs are a document's numbers in the chunk's dictionary `keys`."""
    a, b, text = _vocabularies(path_a, path_b)
    part, chunk, total = TaskContext.get().partitionId() << 32, 0, 0
    names: list = []
    ids: list[tuple[list, list]] = []

    def lists(values: np.ndarray, doc: np.ndarray, kind) -> pa.Array:
        cuts = np.searchsorted(doc, np.arange(len(names) + 1)).astype(np.int32)
        each = pa.ListArray.from_arrays(pa.array(cuts), pa.array(values, kind))
        return pa.concat_arrays([each, pa.nulls(1, each.type)])

    def one(values: np.ndarray) -> pa.Array:
        each = pa.ListArray.from_arrays(pa.array(np.array([0, len(values)], np.int32)), pa.array(values, pa.int64()))
        return pa.concat_arrays([pa.nulls(len(names), each.type), each])

    def flush(kind) -> pa.RecordBatch:
        *columns, digests, doc, pair, times = _linked(ids, a, b, text)
        keys, number = np.unique(pair, return_inverse=True)
        docs = np.bincount(number, minlength=len(keys)).astype(np.int64)
        rows = [pa.array([*names, None], kind), *(pa.array([*c.tolist(), None], pa.int64()) for c in columns), pa.array([*digests, None], pa.string())]
        rows += [pa.array([part + chunk] * (len(names) + 1), pa.int64()), lists(number, doc, pa.int32()), lists(times, doc, pa.int32()), one(keys), one(docs)]
        return pa.RecordBatch.from_arrays(rows, [*_COLUMNS, "chunk", "pairs", "times", "keys", "docs"])

    for batch in batches:
        kind = batch.column(0).type
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            for doc_id, both in zip(some.column(0).to_pylist(), _encoded(some.column(1).to_pylist(), a, b)):
                names.append(doc_id)
                ids.append(both)
                total += len(both[0]) + len(both[1])
                if total >= TOKENS or len(names) >= DOCS:
                    yield flush(kind)
                    chunk, total = chunk + 1, 0
                    names.clear(), ids.clear()
    if names:
        yield flush(kind)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256), a row for each row of docs.

    n_links counts overlap links, n_shared the pairs that share a group. A pair of ids counts the rows of docs that hold it linked;
    n_best are the links whose pair has the greatest count of its A id (ties included), count_sum the counts over all links. Null and empty
    texts, and texts that one of the tokenizers does not give back byte for byte, have zeros and an empty digest. Rows that repeat
    are rows of their own.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"{_DOC.format(kind=kind)}, chunk long, pairs array<int>, times array<int>, keys array<bigint>, docs array<bigint>"
    rows = cut(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lambda x: _chunked(x, path_a, path_b), schema))
    names = rows.where("keys IS NOT NULL").select("chunk", F.posexplode(F.arrays_zip("keys", "docs")).alias("at", "x")).select("chunk", "at", F.col("x.keys").alias("key"), F.col("x.docs").alias("n"))
    counts = names.groupBy("key").agg(F.sum("n").alias("count"))
    counts = cut(counts.withColumn("a", F.shiftright("key", SHIFT)))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row for each A id: a vocabulary at most
    counts = counts.join(F.broadcast(best), "a").select("key", "count", (F.col("count") == F.col("most")).alias("best"))
    named = names.select("chunk", "at", "key").join(counts, "key").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("x"))
    named = named.select(F.col("chunk").alias("of"), F.col("x.count").alias("count"), F.col("x.best").alias("best"))

    def scored(key, left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = (right.column(k).combine_chunks() for k in ("count", "best"))
        count, best = (np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int64) for x in (count, best))
        n_best, total = [], []
        for p, t in zip(left.column("pairs"), left.column("times")):
            p, t = p.values.to_numpy(), t.values.to_numpy().astype(np.int64)
            n_best.append(int(best[p] @ t) if len(p) else 0)
            total.append(int(count[p] @ t) if len(p) else 0)
        return pa.table([*(left.column(c) for c in _COLUMNS[:-1]), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), left.column("groups_sha256")], [*_COLUMNS[:-1], "n_best", "count_sum", "groups_sha256"])

    each = rows.where("keys IS NULL").select(*_COLUMNS, "chunk", "pairs", "times")
    return each.groupBy("chunk").cogroup(named.groupBy("of")).applyInArrow(scored, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, count_sum long, groups_sha256 string")
