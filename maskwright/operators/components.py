"""Connected components over an edge table by alternating large-star and small-star steps.

Each step is a pre-aggregated minimum and a join back, so a node with many edges is spread; nothing reaches the driver
but two sums that tell whether a round changed the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import drop_written, written


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, v): for each node with an edge that isn't its component's smallest node, that node.  `edges`: u, v long, no nulls."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        then = written(_small(_large(now)), "edges")
        drop_written(now)
        now = then
        sums = tuple(now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if sums == seen or not sums[0]:
            return now
        seen = sums
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
