"""Connected components by contraction; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.sources.staging import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is one node of its component.

    In each round every node moves to the neighbour of the smallest hash, if
    that is smaller than its own, and on to where that one moves; nodes that
    meet are one from then on.  The edges left shrink by a constant share, so
    the rounds grow with the logarithm of the longest path.  Neighbours are
    combined before they are shuffled, so a node may have any number of them.
    """
    left = materialize(edges.filter("a != b").select("a", "b").distinct(), "edges")
    ends = F.explode(F.array("a", "b")).alias("node")
    labels = left.select(ends).distinct().withColumn("root", F.col("node"))
    labels = materialize(labels, "labels")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        place = F.struct(F.xxhash64("b").alias("hash"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a").alias("hash"), F.col("a").alias("to"))
        first = both.groupBy("a").agg(F.min(place).alias("_least")).select(
            F.col("a").alias("node"), F.least("_least", own)["to"].alias("to")
        )
        first = materialize(first, "moves")
        onward = first.select(F.col("node").alias("to"), F.col("to").alias("last"))
        moves = materialize(first.join(onward, "to").select("node", F.col("last").alias("to")), "moves")
        moved = labels.join(moves.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("to", "root").alias("root")
        )
        moved = materialize(moved, "labels")
        rest = left
        for end in ("a", "b"):
            rest = rest.join(moves.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        rest = materialize(rest.filter("a != b").select("a", "b").distinct(), "edges")
        discard(first, moves, labels, left)
        labels, left = moved, rest
    discard(left)
    return labels
