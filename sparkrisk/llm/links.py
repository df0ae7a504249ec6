"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.session import materialize


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that can be reached.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones. The number of rounds
    grows with the logarithm of the longest chain; each is two joins on the node, and its result is
    written, so that no lineage builds up.
    """
    links = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    seen = _digest(links)
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialize(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _digest(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
