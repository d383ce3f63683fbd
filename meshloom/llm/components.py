"""Connected components of a link table, by alternating large and small stars over written tables.

Each round replaces the links of a node by links to the smallest node that it knows, so that chains halve; nothing but the
count of changed links reaches the driver. The smallest neighbours are written before they are joined back, so that both sides
of that join are exchanges which adaptive execution can split when a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def stars(links: DataFrame, large: bool) -> DataFrame:
    """large: a node's larger neighbours link to its smallest; else it and its smaller neighbours do."""
    near = both_ways(links) if large else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "components-least").withColumnRenamed("a", "n")
    joined = near.join(least, near.a == least.n)
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    to_least = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """links(a, b) to (node, component): the smallest node of each component; nodes without a link do not appear."""
    now = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    mark = None
    for _ in range(rounds):
        now = materialise(stars(stars(now, True), False), "components")
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if was == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
