"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and an equi-join back, so a
node with any number of neighbours is never gathered in one task.  Each round's edges are
written to the shared folder; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: neighbours above u join the least of u's neighbourhood; small: those below, and u."""
    if large:
        e = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        out = e.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    # the small star drops what the large one leaves twice
    return out.where("u != v") if large else out.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v: long) to (node, label): label is the least node of the component.  Nodes
    without an edge to another node are left out."""
    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        mark = seen
        edges = written(_star(_star(edges, True), False), "cc")
