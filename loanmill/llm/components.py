"""Connected components of a large, sparse link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmill.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(`node`, `root`) of every node in the links (`a`, `b`); the root is the component's smallest node.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) on written tables until no link changes.
    Each step is a grouped minimum, which is combined before it is shuffled, and an equi-join; links
    never meet on one task or on the driver, only their count and checksum do. The minimums are written before they are
    joined: small ones then travel to the links, and of large joins a frequent node can be split.
    """
    links = staged(_oriented(links.select("a", "b")), "links")
    state = _state(links)
    while True:
        links = staged(_small_star(staged(_large_star(links), "large-star")), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _oriented(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest node next to it."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least-neighbours")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the smallest of them."""
    least = staged(links.groupBy("a").agg(F.min("b").alias("least")), "least-neighbours")
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).distinct()
