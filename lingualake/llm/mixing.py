"""Mixing sources to target weights by the cube method (balanced sampling).

A source's target over its size is a number of whole copies plus a fraction. The fraction is the inclusion probability
of every document of the source; the cube method makes it 0 or 1 document by document: it moves the probabilities of
three documents at a time along the null space of the balancing constraints (the number of documents, the number of
words), until at most two of a block stay fractional. Blocks have a bounded number of documents, the documents left by
all blocks of a source make the blocks of the next round, and so on until one small block a source is left. In its
landing those last one or two documents are taken in part: of their words the share that is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small, word_array, word_count

#: Documents of a block of the flight phase; hot sources have many blocks.
BLOCK = 2000
LEFT = 2
_EPS = 1e-9


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities moved to 0 or 1, at most two staying between; sums of prob and of prob * size stay as they are."""
    p = prob.astype(float).copy()
    scale = max(1.0, float(size.mean())) if len(size) else 1.0
    x = size / scale
    todo = [i for i in range(len(p)) if _EPS < p[i] < 1 - _EPS]
    draws = rng.random(len(todo) + 1)
    hold: list[int] = []
    for step, i in enumerate(todo):
        hold.append(i)
        if len(hold) < 3:
            continue
        a, b, c = hold
        # orthogonal to (1, 1, 1) and to the sizes
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if u[0] == u[1] == u[2] == 0:
            u = (1.0, -1.0, 0.0)
        up, down = np.inf, np.inf
        for k, d in zip(hold, u):
            if d > 0:
                up, down = min(up, (1 - p[k]) / d), min(down, p[k] / d)
            elif d < 0:
                up, down = min(up, -p[k] / d), min(down, (1 - p[k]) / -d)
        move = up if draws[step] * (up + down) < down else -down
        for k, d in zip(hold, u):
            p[k] += move * d
        hold = [k for k in hold if _EPS < p[k] < 1 - _EPS]
    p[p <= _EPS], p[p >= 1 - _EPS] = 0.0, 1.0
    return p


def source_targets(sizes: list[tuple[str | None, int]], weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> list[float]:
    """Targets of sources in the order given: by weight, none above `most` times its size, the excess shared again."""
    order = sorted(range(len(sizes)), key=lambda i: (sizes[i][0] is None, (sizes[i][0] or "").encode()))
    weight = {i: weights[k % len(weights)] for k, i in enumerate(order)}
    left, target, free = share * sum(s for _, s in sizes), {}, set(order)
    while free:
        unit = left / sum(weight[i] for i in free)
        full = {i for i in free if unit * weight[i] > most * sizes[i][1]}
        if not full:
            target |= {i: unit * weight[i] for i in free}
            break
        for i in sorted(full):
            target[i] = most * sizes[i][1]
            left -= target[i]
        free -= full
    return [float(target[i]) for i in range(len(sizes))]


def _round(rows: DataFrame) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mark", "doc_id", "size"], kind="stable").reset_index(drop=True)
        seed = [int(pdf["block"].iloc[0]) + 1, int(pdf["seed"].iloc[0]) & 0xFFFFFFFF]
        pdf["prob"] = flight(pdf["prob"].to_numpy(float), pdf["size"].to_numpy(float), np.random.default_rng(seed))
        return pdf

    return rows.groupBy("source", "block").applyInPandas(run, rows.schema)


def mix_sources(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of docs (doc_id, text, source).

    size counts the words of the text (null: 0); sources by code point, null last, weigh 5, 2, 1, repeating. taken is the
    words that the mix takes of the row, repeats counted: at most twice its size. A document is taken whole, twice, or
    not at all (ties of the draw go by hash and id), but for the at most two of each source on which the sampling lands: those give part of their words, so that
    each source's words meet its target within two. Same rows, same result. Rows that repeat are documents of their own.
    The sources themselves (one row each) go to the driver; documents and their probabilities never do. `also` names columns
    of docs to carry along.
    """
    rows = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *also))
    spark = docs.sparkSession
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).collect()  # one row a source
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    targets = source_targets([(r["source"], r["source_size"]) for r in found])
    plan = [(r["source"], r["source_size"], r["n"], t, min(2.0, t / r["source_size"]) if r["source_size"] else 0.0) for r, t in zip(found, targets)]
    plan = spark.createDataFrame(plan or [], "source string, source_size long, n long, target double, ratio double")
    same = F.col("s.source").eqNullSafe(F.col("p.source"))
    rows = rows.alias("s").join(small(plan.alias("p"), len(found)), same).select("doc_id", *also, "s.source", "size", "source_size", "n", "target", F.floor(F.least(F.col("ratio"), F.lit(1.9999999999))).cast("int").alias("copies"), "ratio")
    rows = rows.withColumn("prob", F.col("ratio") - F.col("copies")).drop("ratio")
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "size")).withColumn("seed", F.xxhash64("source"))
    left = max((r["n"] for r in found), default=0)
    done, count, k = None, F.col("n"), 0
    while left:
        blocks = F.greatest(F.lit(1), F.ceil(count / F.lit(BLOCK))).cast("int")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("mark", "doc_id", F.lit(k)), blocks).cast("int"))
        rows = cut(_round(rows))
        most = -(-left // BLOCK)
        between = (F.col("prob") > 0) & (F.col("prob") < 1)
        if most <= 1:
            done = rows if done is None else done.unionByName(rows)
            break
        settled = rows.where(~between)
        done = settled if done is None else done.unionByName(settled)
        rows = rows.where(between)
        left, count, k = most * LEFT, blocks * LEFT, k + 1
    rows = rows if done is None else done
    taken = F.round(F.col("size") * (F.col("copies") + F.col("prob"))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *also)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of docs: each document as often as it is taken, the last time in part if so.

    A part is the first words of the text, joined by one space. Documents without words give none.
    """
    tagged = cut(docs.withColumn("__rid", F.monotonically_increasing_id()))  # rows are told apart by their place, not by doc_id
    take = mix_sources(tagged, ("__rid",)).where("size > 0 AND taken > 0")
    take = cut(take.select("__rid", F.col("taken").alias("__taken"), F.col("size").alias("__size")))
    rows = tagged.join(small(take), "__rid")
    times = F.ceil(F.col("__taken") / F.col("__size")).cast("int")
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), times)))
    part = (F.col("__copy") * F.col("__size") - F.col("__taken")).cast("int")
    words = word_array(F.col("text"))
    text = F.when(part <= 0, F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), (F.col("__size") - part).cast("int")), " "))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
