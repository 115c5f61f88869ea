"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stowage.sources.files import Scratch

_TASK_ROWS = 20_000  # links that a file of an intermediate table is for


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a and b); a component is named by its least node.

    Each round takes the least label among a node and its neighbours, then the label
    of that label, so that rounds grow with the logarithm of a chain's length.
    """
    # As few files as the links ask for: each round reads and writes tables that shrink to labels.
    parts = links.count() // _TASK_ROWS + 1
    both = scratch.table(links.select("a", "b").union(links.select("b", "a")).distinct().coalesce(parts), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("least"))
    labels = scratch.table(labels.select(F.col("a").alias("node"), F.least("a", "least").alias("component")).coalesce(parts), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("least"))
        stepped = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("before"), F.least("component", "least").alias("via")
        )
        of_label = labels.select(F.col("node").alias("label"), F.col("component").alias("next"))
        jumped = stepped.join(of_label, F.col("via") == F.col("label")).select("node", "before", F.col("next").alias("component"))
        jumped = scratch.table(jumped.coalesce(parts), "labels")
        labels = jumped.select("node", "component")
        if jumped.where("before != component").isEmpty():
            return labels
