"""Connected components over links, as joins and groupings only.

Alternates two rewritings of the links (large star, small star; Kiveris et
al., "Connected Components in MapReduce and Beyond", 2014) until nothing
changes.  Each round is written to the shared folder, so no round depends on
the lineage of the ones before, and nothing but two numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of ``links`` (u, v).

    Nodes without a link are not returned; links to oneself are ignored.
    """
    links = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == before or now[0] == 0:
            break
        before = tuple(now)
        links = stored(_small_star(_large_star(links)), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
