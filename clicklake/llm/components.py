"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import stored


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node and label, the smallest node of its component; ``edges`` has a and b (longs), in any order or number.

    In each round every node is merged into the smallest among itself and its neighbours, or into that one's own choice,
    and edges are redrawn between what nodes were merged into. Edges inside a merged node vanish, so rounds shrink fast; none
    left is the end. Each round is written to the shared scratch folder; ``rows`` is about how many nodes there may be.
    """
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", rows)
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = stored(least.select(F.col("a").alias("node"), F.least("a", "b").alias("parent")), "parents", rows)
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        parents = stored(parents.join(above, "parent").select("node", F.col("root").alias("parent")), "parents", rows)
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            moved = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
        labels = stored(labels, "labels", rows)
        ends = [parents.select(F.col("node").alias(x), F.col("parent").alias(f"to_{x}")) for x in ("a", "b")]
        redrawn = edges.join(ends[0], "a").join(ends[1], "b").where("to_a <> to_b")
        redrawn = redrawn.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        edges = stored(redrawn, "edges", rows)
        if edges.isEmpty():
            return labels
