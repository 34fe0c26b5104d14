"""Connected components of a distributed list of links (large star / small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bankmart.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """At most one row per edge; equal rows meet at the end of the small star."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def stars(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node with a link that is not its component's smallest
    node; component is the smallest node.  Rounds grow with the logarithm of the longest
    chain; each is written to the shared folder, and counted as it is written."""
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    before = None
    while True:
        seen = Observation()
        edges = staged(_small_star(_large_star(edges)).observe(
            seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")), "links")
        state = seen.get
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node with a link; component is the smallest node."""
    return with_roots(stars(links, left, right))


def with_roots(found: DataFrame) -> DataFrame:
    """``stars`` with a row for the smallest node of each component too."""
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
