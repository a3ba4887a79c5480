"""Connected components of links by alternating star contraction, without collecting them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.store import stage

ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of the undirected links (a, b): the smallest node that links reach.

    Each round hangs every larger neighbour of a node, then every node itself, on the smallest neighbour; the number of rounds grows with
    the logarithm of the longest chain.  Neighbours are never gathered: only minima are grouped, and joined back.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        # Now every link points down; hang all lower neighbours of a node, and the node, on the lowest.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(lowest.select("a", F.col("m").alias("b")))
        edges = stage(moved.filter("a <> b").distinct(), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.col("m").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
