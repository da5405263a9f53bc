"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.session import stage


def _least(arrows: DataFrame) -> DataFrame:
    """The smallest neighbour of each node: combined before the shuffle, so a hub costs a row per task."""
    return arrows.groupBy("u").agg(F.min("v").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges that point from the larger to the smaller node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("u", "m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = stage(large.distinct())
    least = _least(large)
    turned = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the links ``u, v``: the root is the smallest node that can be reached.

    Each round's links are written to the shared folder, so plans stay short
    and a lost executor costs no more than a round. Nodes without a link, links
    of a node to itself and NULL ends give no row; an empty table gives none.
    """
    ends = edges.filter("u is not null and v is not null and u <> v")
    now = stage(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        # what is left to do, told by two numbers
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        now = stage(_round(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
