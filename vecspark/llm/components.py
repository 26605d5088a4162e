"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.sources.workspace import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component_id``, the smallest node reachable, of every node with an edge.

    ``edges`` has the columns ``a`` and ``b``.  Each round points every node at its smallest
    neighbour and contracts the edges to what they point at, so at least every second node
    goes.  A round is a few joins and aggregations with partial sums, written once; the driver
    only learns whether edges are left.
    """
    both = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = materialize(both.filter("a < b").distinct(), "edges")
    labels = None
    while labels is None or not left.isEmpty():
        ends = left.select(F.col("b").alias("node"), F.col("a").alias("to"))
        ends = ends.unionByName(left.select(F.col("a").alias("node"), F.col("a").alias("to")))
        parents = materialize(ends.groupBy("node").agg(F.min("to").alias("parent")), "parents")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component_id")
        else:
            moved = parents.select(F.col("node").alias("component_id"), "parent")
            labels = materialize(
                labels.join(moved, "component_id", "left").select(
                    "node", F.coalesce("parent", "component_id").alias("component_id")
                ),
                "labels",
            )
        up = left.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        up = up.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
        left = materialize(
            up.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .filter("a < b")
            .distinct(),
            "edges",
        )
    return labels
