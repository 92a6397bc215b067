"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("root")).select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.union(least.select("a", F.col("root").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in ``links`` (a, b long); the root is the smallest node of its component.

    Each round is one written table, whose size and digest (a single row) tell
    the driver when nothing changes any more. A node with very many links is
    met only in sums that combine before the shuffle and in joins whose large
    partitions Spark splits. Self links are ignored; no links give no rows.
    """
    current = stored(links.filter(F.col("a") != F.col("b")).select(F.col("a").cast("long"), F.col("b").cast("long")), "links")
    seen = None
    while True:
        current = stored(_small_star(_large_star(current)), "links")
        state = tuple(current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root")).distinct()
