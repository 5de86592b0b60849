"""Connected components of a graph of accepted pairs, with 64-bit labels.

Alternating star steps: every node points to the least label it has seen, until no edge changes.
A hub is a sum with partial aggregation, not a group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.storage import write_table


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``u, v`` (BIGINT) to ``node, component``: the least node of each component names it.

    Nodes with null are ignored, loops make single components; no edges give no rows.
    """
    e, _ = write_table(edges.select("u", "v").filter("u is not null and v is not null").distinct(), "edges")
    nodes = _both(e).select(F.col("u").alias("node")).distinct()
    e = e.filter("u <> v")
    while True:
        # large star: neighbours above a node join the least label around it
        around = _both(e)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, _ = write_table(large.filter("u <> v").distinct(), "star")
        # small star: a node and its lower neighbours join the least of them
        low = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small, _ = write_table(small.distinct(), "star")
        # done when every node has one edge, to a node that is nobody's child
        several = small.groupBy("u").count().filter("count > 1").isEmpty()
        if several and small.join(small.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            break
        e = small
    return nodes.join(small.select(F.col("u").alias("node"), F.col("v").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("component"))
