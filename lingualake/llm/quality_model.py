"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged, softmax, trained by numpy SGD.

A document is the mean of the learned vectors of its words, its pairs of neighbouring words and its 3- to 5-byte grams,
each hashed to one of 2**16 rows; a softmax layer over that mean gives the two class probabilities. An average of grams cannot
tell that a text repeats itself with words of its own; so word n-grams that end with their first word (`w w` to `w ? ? ? w`)
count besides as grams whose words are left open, in rows of their own. Training takes a bounded
sample of labelled documents: tasks count their grams, one task runs the descent over the counts, and what comes back
is a number for each hash bucket. Scoring takes every document whole, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vectext as V
from .common import BROADCAST_ROWS, small

BUCKET_BITS = 16
GRAMS = (3, 4, 5)
#: Distances at which a word that comes again makes an open gram, and how many rows each of these has (they are rare in number).
LAGS, WEIGHT = (1, 2, 3, 4), 5
BUCKETS = (1 << BUCKET_BITS) + len(LAGS) * WEIGHT
#: Bytes whose grams are hashed at once; a longer document is a chunk of its own.
CHUNK = 200_000


@dataclass
class Model:
    """What one occurrence of each bucket adds to the logit of class 1 over class 0, and the logit without any."""

    margins: np.ndarray
    bias: float


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word, pair of words and gram of the rows of one chunk."""
    shift = np.uint64(64 - BUCKET_BITS)
    starts, ends, row = V.words(data, offs)
    h = V.word_hashes(data, starts, ends)
    at = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(row))
    buckets, rows = [(h >> shift).astype(np.int32)], [at]
    if len(h) > 1:
        inside = at[1:] == at[:-1]
        buckets.append((V.mix(h[:-1] * V._BASE + h[1:])[inside] >> shift).astype(np.int32))
        rows.append(at[1:][inside])
    for k, lag in enumerate(LAGS):
        if len(h) > lag:
            again = at[lag:][(h[lag:] == h[:-lag]) & (at[lag:] == at[:-lag])]
            buckets.append(np.tile(np.arange(WEIGHT, dtype=np.int32) + ((1 << BUCKET_BITS) + k * WEIGHT), len(again)))
            rows.append(np.repeat(again, WEIGHT))
    of = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    value = V._BYTE[data]
    for g in GRAMS:
        if len(data) >= g:
            h = np.full(len(data) - g + 1, np.uint64(g))
            for i in range(g):
                h = h * V._BASE + value[i : len(data) - g + 1 + i]
            inside = of[: len(h)] == of[g - 1 :]
            buckets.append((V.mix(h[inside]) >> shift).astype(np.int32))
            rows.append(of[: len(h)][inside])
    return np.concatenate(buckets), np.concatenate(rows)


def counted(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its buckets and how often each occurs."""
    for _, data, offs in V.chunks(text, CHUNK):
        bucket, row = features(data, offs)
        order = np.argsort(row, kind="stable")
        cuts = np.searchsorted(row[order], np.arange(len(offs)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield np.unique(bucket[order[a:b]], return_counts=True)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dim: int = 8, epochs: int = 12, rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent on the log loss over (buckets, counts), one document a step, in a fixed shuffled order."""
    rng = np.random.default_rng(seed)
    vectors, output = rng.normal(0, 0.1, (BUCKETS, dim)), rng.normal(0, 0.1, (dim, 2))
    bias = np.log(np.clip(np.bincount(labels, minlength=2) / len(labels), 1e-3, None))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(docs)):
            ids, count = docs[i]
            if not len(ids):
                continue
            weight = count / count.sum()
            mean = weight @ vectors[ids]
            logit = mean @ output + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output @ p
            output -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            vectors[ids] -= (step * 20 * weight)[:, None] * back[None, :]
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, sample: int = 3000) -> Model:
    """A model of labels.quality from at most `sample` labelled documents, those of the smallest id hashes, whose
    crc32(doc_id) mod 5 is not 0. Null ids, labels other than 0 and 1, and ids with contradicting labels are left out.
    Without any, every score is 0.5."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
    known = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(small(known, min(sample, BROADCAST_ROWS)), "doc_id").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.min("text").alias("text"))

    def count(batches):
        for b in batches:
            got = list(counted(b.column(2)))
            at = np.concatenate([[0], np.cumsum([len(x) for x, _ in got])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int32), *x]).astype(np.int32))) for x in zip(*got)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1), *lists], ["doc_id", "quality", "ids", "counts"])

    def descend(batches):
        seen, label = [], []
        for b in batches:
            seen += [(i.values.to_numpy(), c.values.to_numpy()) for i, c in zip(b.column(2), b.column(3))]
            label += b.column(1).to_pylist()
        if label:
            m = fit(seen, np.array(label, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([m.margins.tobytes()]), pa.array([m.bias])], ["margins", "bias"])

    grams = rows.mapInArrow(count, "doc_id long, quality int, ids array<int>, counts array<int>")
    # at most `sample` documents, whatever the input: one task descends, and the driver gets one number a bucket
    found = grams.repartition(1).sortWithinPartitions("doc_id").mapInArrow(descend, "margins binary, bias double").collect()
    return Model(np.frombuffer(bytes(found[0]["margins"])), found[0]["bias"]) if found else Model(np.zeros(BUCKETS), 0.0)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with one more column: the probability of class 1. A text without features gets the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model.margins, model.bias))
    at = docs.columns.index("text")

    def run(batches):
        margin, bias = shared.value
        for b in batches:
            out = np.full(b.num_rows, bias)
            for first, data, offs in V.chunks(b.column(at), CHUNK):
                bucket, row = features(data, offs)
                count = np.bincount(row, minlength=len(offs) - 1)
                out[first : first + len(offs) - 1] += np.bincount(row, margin[bucket], len(offs) - 1) / np.maximum(count, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -50, 50))))], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score at least the threshold, with the columns of docs."""
    return score(docs, train(docs, labels), "__score").where(F.col("__score") >= threshold).select(*docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row. Null or empty texts get the prior's score; a null doc_id is
    not held out; rows that repeat score alike; other columns are not read; with no labels every score is 0.5."""
    out = score(docs.select("doc_id", "text"), train(docs, labels))
    held = F.coalesce(F.expr("crc32(CAST(doc_id AS STRING)) % 5 = 0"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
