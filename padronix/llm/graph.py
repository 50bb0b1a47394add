"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padronix.llm.batches import materialize


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label) for every node of `links` (a, b): label is the smallest node reachable, by any orderable type.

    In each round a node takes the smallest label among its neighbours', and labels are then replaced by their own
    labels. Both steps are grouped minima, which are combined before their exchange, so a node with very many links
    is no hot group. The rounds follow the logarithm of the longest shortest path in practice. Each round is a written
    table in the shared folder; lost executors cost one round. The driver sees one number per round. Links with a null
    end are ignored; an empty table gives an empty one.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = materialize(both.union(both.select("b", "a")).distinct(), folder, f"{name}-links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    labels = materialize(labels, folder, f"{name}-0")
    step = 0
    while True:
        step += 1
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("onward"))
        moved = lower.join(jump, "label").select("node", F.least("label", "onward").alias("label"), "was")
        moved = materialize(moved, folder, f"{name}-{step}")
        changed = moved.where("label <> was").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
