"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is a few grouped joins over the links (never on the driver) and is
written to the shared folder, so lost executors recompute one round at most.
A hub's links don't meet in one task: hubs are joined by broadcast, their number being bounded.

Links that hold a null are ignored, as are links of a node with itself; repeated
links count once; an empty table gives no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import join_groups, materialise


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    return join_groups(both.where("v > u"), least, ["u"], "n", 2 * n_edges).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """links (u long, v long) -> (node, component), component being the smallest node reachable; nodes without links don't occur."""
    edges = materialise(links.select("u", "v").where("u <> v").distinct(), "links")
    seen = (edges.count(), None)
    while True:
        edges = materialise(_small_star(_large_star(edges, seen[0])), "stars")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == now:
            break
        seen = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
