"""Connected components of links by alternating large and small stars; the links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links(a, b): one row (id, component) for each node with a link, component being the least id that it reaches.

    A round points every node's larger neighbours to its least neighbour, then every node's smaller neighbours to the least of
    them; minima are combined before the shuffle, so a hub costs one row a task. Each round is a written table. The number of
    rounds grows with the logarithm of the longest chain; running out of rounds is an error, not a cut."""
    stars = table(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(most_rounds):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        twice = stars.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        inner = stars.select(F.col("v").alias("u")).distinct().join(stars, "u", "left_semi").select("u", F.lit(0).alias("n"))
        if not twice.unionByName(inner.select("u", F.col("n").cast("long"))).take(1):
            roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
