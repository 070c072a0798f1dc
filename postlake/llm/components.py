"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _are_stars(edges: DataFrame) -> bool:
    """Every node has one centre and no centre has one."""
    ends = edges.select("a", F.lit(1).alias("centres"), F.lit(0).alias("is_centre")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("centres"), F.lit(1).alias("is_centre")))
    nodes = ends.groupBy("a").agg(F.sum("centres").alias("centres"), F.max("is_centre").alias("is_centre"))
    return nodes.where("centres > 1 or (centres = 1 and is_centre = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    more = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(more).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has a and b; the result has a row (a, b) for each node but the least of its component, which is b.
    Loops and repeated edges don't matter; without edges the result is empty."""
    out = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    out = stored(out, "edges")
    while not _are_stars(out):
        out = stored(_small_star(_large_star(out)), "stars")
    return out
