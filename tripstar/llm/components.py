"""Connected components of a link table, by alternating large-star / small-star.

Input: rows (a, b) of an orderable type.  Output: (node, component) for every
node of a link, where component is the smallest node reachable.  Each round is
two shuffles over the links and is checkpointed, so lineage stays short and a
lost executor costs one round; the number of rounds is logarithmic in practice.
Links are star-shaped after every round, so there are never more links than the
input had.  Nothing but a count and a checksum per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.llm.common import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    links = cut_lineage(spark, links.select("a", "b").where("a <> b").distinct())
    seen = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
        if not seen[0]:
            break
        links = cut_lineage(spark, _small_star(_large_star(links)))
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
