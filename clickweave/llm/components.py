"""Connected components of a table of links, by contraction.

In each round every node is hooked to its smallest neighbour; links are rewritten
to what their ends are hooked to, until none is left. Hooking and rewriting are an
aggregate and joins whose other side is unique per node, so a node with very many
links, or a component with a third of all nodes, stays spread. Every round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickweave.operators.skew import skew_join
from clickweave.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the same within a component."""
    links = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    both = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = materialize(both.withColumn("label", F.col("node")), "labels")
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        hooked = materialize(ends.groupBy(F.col("a").alias("label"))
                             .agg(F.least(F.min("b"), F.col("label")).alias("to")), "hooked")
        labels = materialize(
            skew_join(labels, hooked, ["label"], "left")
            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        first = skew_join(links, hooked.select(F.col("label").alias("a"), F.col("to").alias("to_a")),
                          ["a"])
        moved = skew_join(first, hooked.select(F.col("label").alias("b"), F.col("to").alias("to_b")),
                          ["b"])
        links = materialize(moved.where("to_a <> to_b")
                            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(),
                            "links")
    return labels
