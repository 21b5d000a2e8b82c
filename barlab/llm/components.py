"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _unfinished(e: DataFrame) -> bool:
    """Whether a node has two parents, or a parent and a child: then the edges aren't stars yet."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        e.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component, itself left out) for edges (u, v) of longs.

    Every round moves a node's neighbours to its smallest one, so trees flatten in
    a logarithmic number of rounds; the driver only learns whether another one is
    needed. A round is partial aggregates and joins; its table is staged.
    """
    e = ws.stage(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while _unfinished(e):
        both = _both_ways(e)
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(moved.select("u", F.col("m").alias("v")))
        after = ws.stage(small.filter("u != v").distinct(), "stars")
        ws.release(e)
        e = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
