"""Heading candidates: line filters and the merge of like neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliolens.functions import text as tx
from foliolens.operators.lines import with_page_context, with_word_classes
from foliolens.plans.chunks import ROWS_PER_CHUNK, carry, chunk_of
from foliolens.plans.lineage import cut, salted_join, sized_join

MEAN_TOLERANCE = 1e-9
BAND_POINTS = 256

# Neighbouring candidates that agree in all of these are one heading.
RUN_FIELDS = ["font_size", "bold", "is_upper", "ends_with_colon", "is_short", "is_numbered", "page", "first_page"]


def not_page_last() -> Column:
    """Keeps lines whose text differs from the bottom-most line of the page; needs the page context."""
    return ~F.col("text").eqNullSafe(F.col("page_last_text"))


def drop_repeats(lines: DataFrame, counted: DataFrame | None = None, min_repeat: int = 3) -> DataFrame:
    """Drops lines whose (collapsed) text and rounded top occur at least `min_repeat` times in the document.

    Occurrences are counted over `counted` (all lines of the document), by default over `lines`.
    Only repeated keys are joined back, each cut into pieces by page, as a running header may
    make up most of a table.
    """
    counted = lines if counted is None else counted
    key = [F.lower("text").alias("_text"), F.bround("line_top", 1).alias("_top")]
    repeated = (
        counted.select("doc_id", *key)
        .groupBy("doc_id", "_text", "_top")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_repeat)
        .drop("_n")
    )
    return salted_join(
        lines.select("*", *key), repeated, ["doc_id", "_text", "_top"], "left_anti", salt="page"
    ).drop("_text", "_top")


def short_enough(min_alnum: int = 3, max_length: int = 100, max_words: int = 15) -> Column:
    """Short lines with some letters or digits; the cheap tests on ready features come first."""
    return (
        (F.col("length") <= max_length) & (F.col("num_words") <= max_words) & tx.has_alnum("text", min_alnum)
    )


def large_enough(z: float = 0.25) -> Column:
    """Font size at or above page mean + z sample deviations; needs the page context."""
    return F.col("font_size") >= F.col("page_mean") + z * F.col("page_std") - MEAN_TOLERANCE


def filter_candidates(
    lines: DataFrame, z: float = 0.25, remove_repeats: bool = True, min_alnum: int = 3, max_length: int = 100, max_words: int = 15
) -> DataFrame:
    """All line filters over lines with features; the page context is added on the way.

    Page statistics and repeat counts come from all lines, before any filter.  Long lines cannot pass, so they
    go through the shuffles without their text: only their place and size count.  Texts are kept up to twice
    the limit, as a line that equals a short one in lower case is at most so long.
    """
    slim = lines.withColumn("text", F.when(F.col("length") <= 2 * max_length, F.col("text")))
    kept = with_page_context(slim).where(
        short_enough(min_alnum, max_length, max_words) & not_page_last() & large_enough(z)
    )
    return drop_repeats(kept, counted=slim.where(F.col("text").isNotNull())) if remove_repeats else kept


def _banded(candidates: DataFrame, band: float, limit: int) -> DataFrame:
    """Adds _chunk, which follows (line_top, line_idx) inside a page: bands of fixed height.

    Lines do not overlap on a real page, so a band holds few.  Where it holds more than `limit` all the same (no
    layout, one top for all lines), the band is cut further by top and by ranges of line_idx.
    """
    banded = candidates.withColumn("_band", chunk_of("line_top", band))
    keys = ["doc_id", "page", "_band"]
    crowded = cut(banded.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).drop("_n"))
    if crowded.isEmpty():
        return banded.withColumnRenamed("_band", "_chunk")
    marked = sized_join(banded, crowded.withColumn("_crowded", F.lit(True)), keys, "left", salt="line_idx")
    inside = F.coalesce("_crowded", F.lit(False))
    top = F.when(inside, F.col("line_top")).otherwise(F.lit(0.0))
    part = F.when(inside, chunk_of("line_idx", limit)).otherwise(F.lit(0).cast("long"))
    return marked.withColumn("_chunk", F.struct("_band", top.alias("top"), part.alias("part"))).drop("_band", "_crowded")


def with_runs(candidates: DataFrame, band: float = BAND_POINTS, limit: int = ROWS_PER_CHUNK) -> DataFrame:
    """Numbers, per page, the runs of neighbouring candidates that agree in the run fields.

    Neighbours are taken by line_top.  A task sees the lines of one band of a page; runs go on across bands.
    """
    keys, order = ["doc_id", "page"], ["line_top", "line_idx"]
    rank, fields = F.struct(*order), F.struct(*RUN_FIELDS)
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    previous = F.lag(fields).over(inner)
    local = _banded(candidates, band, limit).withColumn(
        "_starts", (previous.isNotNull() & ~previous.eqNullSafe(fields)).cast("int")
    )
    summaries = [
        F.min_by(fields, rank).alias("_head"),
        F.max_by(fields, rank).alias("_tail"),
        F.sum("_starts").alias("_inside"),
    ]

    def combine(part, w):
        fresh = ~F.coalesce(F.lag("_tail").over(w.ordered).eqNullSafe(F.col("_head")), F.lit(False))
        opened = part.withColumn("_fresh", fresh.cast("int"))
        offset = F.coalesce(F.sum("_inside").over(w.before), F.lit(0)) + F.sum("_fresh").over(w.through)
        return opened.select(*keys, "_chunk", (offset - 1).alias("_offset"))

    through = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = carry(local, keys, "_chunk", summaries, combine)
    return joined.withColumn("run_id", F.col("_offset") + F.sum("_starts").over(through)).drop(
        "_chunk", "_starts", "_offset"
    )


def merge_runs(candidates: DataFrame, band: float = BAND_POINTS, limit: int = ROWS_PER_CHUNK) -> DataFrame:
    """One row per run: texts joined, lengths and word counts added, extent widened, the rest from its first line."""
    rank = F.struct("line_top", "line_idx")
    changed = {"text", "length", "num_words", "line_top", "line_bottom"}
    first = [c for c in candidates.columns if c not in changed | {"doc_id", "page"}]
    pieces = F.array_sort(F.collect_list(F.struct("line_top", "line_idx", "text")))
    merged = with_runs(candidates, band, limit).groupBy("doc_id", "page", "run_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), " ").alias("text"),
        F.sum("length").cast("int").alias("length"),
        F.sum("num_words").cast("int").alias("num_words"),
        F.min("line_top").alias("line_top"),
        F.max("line_bottom").alias("line_bottom"),
        F.min_by(F.struct(*first), rank).alias("_first"),
    )
    order = {"page": F.col("page")} | {c: F.col(f"_first.{c}") for c in first}
    return merged.select(*[order.get(c, F.col(c)).alias(c) for c in candidates.columns])


def candidates(lines: DataFrame, z: float = 0.25, remove_repeats: bool = True, words: bool = False) -> DataFrame:
    """Filtered and merged heading candidates from lines with features.

    The few lines that pass are written out before the merge, which reads them twice.  With `words`, they get the word-class
    counts, which no filter looks at; those of a run are those of its first line.
    """
    kept = filter_candidates(lines, z, remove_repeats)
    return merge_runs(cut(with_word_classes(kept) if words else kept))
