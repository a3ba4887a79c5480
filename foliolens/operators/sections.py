"""Blocks to sections: font-size levels and heading slices."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.functions.text import clean_title
from foliolens.plans.chunks import attach, chunk_of, running_sum
from foliolens.plans.shipping import by_value

SSE_DIGITS = 6


def split_points(points, counts, groups: int) -> list[int]:
    """The borders that split ascending points, each with a count, into groups of least squared deviation.

    `best[f]` is the least cost of the points from `f` on in so many groups.  The border that reaches it never moves back as `f` grows, so
    each further group is found by halving: the border of the middle one bounds those of both halves.  Costs are compared
    at six decimals; of equal splits the one whose first border (then second, ...) is smallest counts.  Points are taken from their mean,
    so that sums of squares lose no digits.
    """
    import numpy as np

    points, counts = np.asarray(points, float), np.asarray(counts, float)
    points = points - (points * counts).sum() / counts.sum()
    count, total, squares = (np.append(0.0, np.cumsum(x)) for x in (counts, counts * points, counts * points * points))
    size = len(counts)

    def spread(i, j):
        return squares[j] - squares[i] - (total[j] - total[i]) ** 2 / (count[j] - count[i])

    starts = np.arange(size)
    layers = [spread(starts, size)]
    for more in range(1, groups):
        after, best = layers[-1], np.full(size, np.inf)
        ranges = [(0, size - more - 1, 1, size - more)]  # starts to do, and where their borders can lie
        while ranges:
            low, high, least, most = ranges.pop()
            if low > high:
                continue
            middle = (low + high) // 2
            ends = np.arange(max(least, middle + 1), most + 1)
            cost = spread(middle, ends) + after[ends]
            at = int(cost.argmin())
            best[middle] = cost[at]
            ranges += [(low, middle - 1, least, int(ends[at])), (middle + 1, high, int(ends[at]), most)]
        layers.append(best)
    target, borders, cost, start = np.round(layers[-1][0], SSE_DIGITS), [], 0.0, 0
    for left in range(groups - 1, 0, -1):
        ends = np.arange(start + 1, size - left + 1)
        # The same order of summation as over all splits: groups first to last.
        reached = np.flatnonzero(np.round(cost + spread(start, ends) + layers[left - 1][ends], SSE_DIGITS) <= target)
        end = int(ends[reached[0]]) if len(reached) else int(ends[(spread(start, ends) + layers[left - 1][ends]).argmin()])
        cost, start = cost + spread(start, end), end
        borders.append(end)
    return borders


def _cuts(batches: Iterator) -> Iterator:
    """The two borders that split each document's sizes into three groups."""
    import pandas as pd

    for batch in batches:
        rows = []
        for doc_id, points, counts in zip(batch["doc_id"], batch["points"], batch["counts"]):
            # With up to three sizes, each is a group.
            first, second = split_points(points, counts, 3) if len(points) > 3 else (max(len(points) - 2, 0), len(points) - 1)
            rows.append((doc_id, float(points[second]), float(points[first])))
        yield pd.DataFrame(rows, columns=["doc_id", "h1_from", "h2_from"])


def size_borders(blocks: DataFrame, digits: int = 2) -> DataFrame:
    """Per document the font sizes from which a block is H1 and H2: exact 1-D k-means, k = min(3, distinct sizes).

    Works on the histogram of sizes rounded to `digits`, never on blocks, so a document's row is bounded by
    the range of font sizes; one Arrow batch function splits all histograms.
    """
    bins = blocks.groupBy("doc_id", F.round("font_size", digits).alias("points")).agg(F.count(F.lit(1)).alias("n"))
    histograms = bins.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("points", "n"))).alias("bins"))
    kind = blocks.schema["doc_id"].dataType.simpleString()
    return histograms.select("doc_id", F.col("bins.points").alias("points"), F.col("bins.n").alias("counts")).mapInPandas(
        by_value(_cuts), f"doc_id {kind}, h1_from double, h2_from double"
    )


def with_levels(blocks: DataFrame, digits: int = 2) -> DataFrame:
    """Adds the level H1..H3 of each block from its document's font sizes."""
    chunked = blocks.withColumn("_chunk", chunk_of("block_idx"))
    joined = attach(chunked, ["doc_id"], "_chunk", size_borders(blocks, digits))
    size = F.round("font_size", digits)
    level = F.when(size >= F.col("h1_from"), "H1").when(size >= F.col("h2_from"), "H2").otherwise("H3")
    return joined.withColumn("level", level).drop("_chunk", "h1_from", "h2_from")


def block_sections(blocks: DataFrame) -> DataFrame:
    """Every block as a section of its own, titled by its cleaned text."""
    kept = [c for c in blocks.columns if c not in ("block_idx", "text")]
    return blocks.select(*kept, F.col("block_idx").alias("section_idx"), clean_title("text").alias("title"), "text")


def slice_sections(blocks: DataFrame, is_heading: Column) -> DataFrame:
    """Sections that run from one heading block to the next; blocks before the first heading belong to none."""
    marked = blocks.withColumn("_heading", is_heading.cast("int")).withColumn("_chunk", chunk_of("block_idx"))
    placed = running_sum(marked, ["doc_id"], "_chunk", ["block_idx"], "_heading", "_section").where("_section > 0")
    pieces = F.array_sort(F.collect_list(F.struct("block_idx", "text")))
    head = F.min_by(F.struct("page", "level", "text", "block_idx"), "block_idx")
    return (
        placed.groupBy("doc_id", (F.col("_section") - 1).cast("int").alias("section_idx"))
        .agg(
            head.alias("_head"),
            F.max("block_idx").alias("end_idx"),
            F.array_join(F.transform(pieces, lambda p: p["text"]), " ").alias("text"),
        )
        .select(
            "doc_id",
            "section_idx",
            F.col("_head.page").alias("page"),
            F.col("_head.level").alias("level"),
            clean_title("_head.text").alias("title"),
            F.col("_head.block_idx").alias("start_idx"),
            "end_idx",
            "text",
        )
    )
