"""Connected components of a table of links by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import written


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Links run from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, component): for each node with a link, the least node that it reaches.

    Rounds grow with the logarithm of the longest path. Each round is a
    written table; the driver sees one count and one checksum of it. Links
    may run either way and repeat; a node's link to itself is no link.
    """
    now = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        now = written(small_star(large_star(now)), name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
