"""Connected components as a loop of joins, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) for every node of ``edges`` (a, b): label is the
    smallest node of its component.

    Each round takes the smallest label among a node and its neighbours, then
    follows that label's own label, so paths shorten by half or more a round.
    Minima are pre-aggregated before the shuffle; a label shared by very many
    nodes is a skewed join key that adaptive execution splits. Every round is
    written to the shared folder, and the loop ends when no label changes.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                    .select("node", F.least("node", "near").alias("label"), F.lit(True).alias("moved")), "labels")
    while not labels.where("moved").isEmpty():
        known = labels.select(F.col("node").alias("b"), "label")
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.select("node", "label").join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(step.join(jump, "label").select("node", F.least("label", "next").alias("label"),
                                                        (F.least("label", "next") != F.col("old")).alias("moved")), "labels")
    return labels.select("node", "label")
