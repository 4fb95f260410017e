"""Connected components of a link table on Spark: alternating large-star and small-star steps.

Every step is an aggregate (the smallest neighbour, combined before the shuffle) and a join on
the node; a hub's links are only ever read row by row, and the adaptive skew join splits them.
Each round's links are written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import land


def _toward(neighbours: DataFrame, own: bool) -> DataFrame:
    least = F.min("v")
    return neighbours.groupBy("u").agg((F.least(F.col("u"), least) if own else least).alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_toward(both, True), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _toward(down, False)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) of every node in a link (u, v); root is the smallest node reachable."""
    links = land(links.where("u <> v").select("u", "v").distinct(), f"{name}_0")
    seen, turn = None, 0
    while True:
        turn += 1
        links = land(small_star(large_star(links)), f"{name}_{turn}")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
