"""Connected components of an edge table, by joins alone: no link or label is ever gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (a, b); comp is the smallest node that links reach.

    Each round takes the least label among the neighbours, then that label's own label (pointer jumping),
    so the rounds grow with the logarithm of the longest chain. Both steps combine before they shuffle.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = both.join(label, both.b == label.node).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = label.join(near, "node", "left").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = step.select(F.col("node").alias("at"), F.col("comp").alias("further"))
        step = cut(step.join(jump, step.comp == jump.at, "left").select("node", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")))
        changed = step.where("comp < old").limit(1).count()
        label = step.select("node", "comp")
        if not changed:
            return label
