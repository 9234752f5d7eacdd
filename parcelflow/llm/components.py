"""Connected components by contraction, entirely in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); equal labels mean connected.

    Each round every node points to its smallest neighbour, edges move along the pointers, and loops and
    repeats go. Nodes should be hashes: then no order favours long chains, at least a constant
    share of the nodes disappears per round, and rounds grow with the logarithm of the largest component.
    Aggregates combine before the shuffle, so a node with very many neighbours is no hot spot.
    """

    def tidy(pairs: DataFrame) -> DataFrame:
        different = pairs.filter("a <> b")
        return stored(
            different.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", narrow=True
        )

    edges = tidy(edges.select("a", "b"))
    labels = None
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        pointers = ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
        pointers = stored(pointers, "pointers", narrow=True)
        first, second = (pointers.toDF(x, f"to_{x}") for x in ("a", "b"))
        edges = tidy(edges.join(first, "a").join(second, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")))
        if labels is None:
            labels = pointers
        else:
            moved = labels.join(pointers.toDF("label", "new"), "label", "left")
            labels = stored(moved.select("node", F.coalesce("new", "label").alias("label")), "labels", narrow=True)
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
