"""Spans to lines and blocks, and the features of a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.functions import text as tx
from foliolens.plans.chunks import ROWS_PER_CHUNK, Neighbours, carry, chunk_of

LINE_KEY = ["doc_id", "page", "block_idx", "line_idx"]


def _joined(text: str, order: str, separator: str) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(text).alias("piece"))))
    return F.array_join(F.transform(pieces, lambda p: p["piece"]), separator)


def lines_from_spans(spans: DataFrame) -> DataFrame:
    """Lines with the layout of their first span; lines without an ASCII letter or digit are dropped."""
    lines = spans.groupBy(*LINE_KEY).agg(
        _joined("text", "span_idx", "").alias("raw_text"),
        F.min_by(F.struct("size", "flags", "origin_x"), "span_idx").alias("first"),
        F.min("y0").alias("line_top"),
        F.max("y1").alias("line_bottom"),
    )
    return (
        lines.withColumn("text", tx.collapse("raw_text"))
        .where(tx.has_ascii_alnum("text"))
        .select(
            *LINE_KEY,
            "text",
            F.coalesce("first.size", F.lit(0.0)).alias("font_size"),
            F.coalesce("first.flags", F.lit(0)).alias("flags"),
            F.bround(F.coalesce("first.origin_x", F.lit(0.0)), 2).alias("indent"),
            "line_top",
            "line_bottom",
        )
    )


def blocks_from_spans(spans: DataFrame) -> DataFrame:
    """Blocks with the mean size of their characters and 1-based pages; empty blocks are dropped.

    The lines of a block are joined by line feeds.  A line's text is put together first, so that
    only whole lines meet in the block.
    """
    size = F.char_length("text")
    per_line = spans.groupBy(*LINE_KEY).agg(
        _joined("text", "span_idx", "").alias("line_text"),
        F.sum(F.col("size") * size).alias("points"),
        F.sum(size).alias("characters"),
        F.min("x0").alias("x0"),
        F.min("y0").alias("y0"),
    )
    blocks = per_line.groupBy("doc_id", "page", "block_idx").agg(
        _joined("line_text", "line_idx", "\n").alias("raw_text"),
        F.sum("points").alias("points"),
        F.sum("characters").alias("characters"),
        F.min("x0").alias("x0"),
        F.min("y0").alias("y0"),
    )
    mean = F.when(F.col("characters") > 0, F.col("points") / F.col("characters")).otherwise(F.lit(0.0))
    return (
        blocks.withColumn("text", tx.strip("raw_text"))
        .where(F.col("text") != "")
        .select("doc_id", "block_idx", "text", mean.alias("font_size"), "x0", "y0", (F.col("page") + 1).alias("page"))
    )


def line_flags() -> list[Column]:
    """Row-local features of a line with collapsed text."""
    words = tx.words_of_collapsed("text")
    return [
        F.char_length("text").alias("length"),
        tx.is_upper("text").alias("is_upper"),
        tx.ends_with_colon("text").alias("ends_with_colon"),
        (words <= 8).cast("int").alias("is_short"),
        tx.is_numbered("text").alias("is_numbered"),
        (F.col("page") == 0).cast("int").alias("first_page"),
        words.alias("num_words"),
    ]


def with_line_features(lines: DataFrame, bold_mask: int = 2, words: bool = True) -> DataFrame:
    """Adds bold, text and word-class features; drops lines without an ASCII letter or digit."""
    kept = lines.where(tx.has_ascii_alnum("text")).withColumn("text", tx.collapse("text"))
    features = kept.select(
        "*", tx.bold_from_flags("flags", bold_mask).alias("bold"), *line_flags()
    ).withColumn("indent", F.bround("indent", 2))
    if not words:
        return features
    return with_word_classes(features)


def with_word_classes(lines: DataFrame) -> DataFrame:
    """Adds the nine word-class counts of each line's text."""
    return lines.withColumn("_marks", tx.word_marks("text")).select("*", *tx.mark_counts("_marks")).drop("_marks")


def with_page_context(lines: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Spacing to the neighbouring lines and the statistics of the page, in one pass over the lines.

    Adds spacing_before, spacing_after, page_mean, page_std (sample, 0 for a single line), page_bottom
    and page_last_text (text of the bottom-most line, the last of equals).  All rows of the page count.
    Lines of blocks follow each other block by block; lines without blocks by their number on the page.
    """
    keys = ["doc_id", "page"]
    order = [c for c in ("block_idx", "line_idx") if c in lines.columns]
    near = Neighbours(keys, "_chunk", order, F.struct("line_top", "line_bottom"))
    size = F.col("font_size")
    summaries = [
        *near.summaries,
        F.count(F.lit(1)).alias("_n"),
        F.avg(size).alias("_mean"),
        (F.var_pop(size) * F.count(F.lit(1))).alias("_m2"),
        F.min(size).alias("_low"),
        F.max(size).alias("_high"),
        F.max("line_bottom").alias("_bottom"),
        F.max_by(F.struct("line_top", *order, "text"), F.struct("line_top", *order)).alias("_last"),
    ]

    def combine(part, w):
        whole = w.whole
        uniform = F.min("_low").over(whole) == F.max("_high").over(whole)
        mean = F.sum(F.col("_n") * F.col("_mean")).over(whole) / F.sum("_n").over(whole)
        first = part.select(
            *keys,
            "_chunk",
            *near.carried(w),
            "_n",
            "_mean",
            "_m2",
            F.sum("_n").over(whole).alias("page_lines"),
            uniform.alias("_uniform"),
            F.when(uniform, F.min("_low").over(whole)).otherwise(mean).alias("page_mean"),
            F.max("_bottom").over(whole).alias("page_bottom"),
            F.max(F.col("_last")).over(whole)["text"].alias("page_last_text"),
        )
        spread = F.sum(F.col("_m2") + F.col("_n") * F.pow(F.col("_mean") - F.col("page_mean"), F.lit(2))).over(whole)
        varied = ~F.col("_uniform") & (F.col("page_lines") > 1)
        std = F.when(varied, F.sqrt(spread / (F.col("page_lines") - 1))).otherwise(F.lit(0.0))
        return first.withColumn("page_std", std).drop("_n", "_mean", "_m2", "_uniform")

    chunk = chunk_of("line_idx", rows_per_chunk)
    chunked = lines.withColumn("_chunk", F.struct(*order[:-1], chunk.alias("lines")) if order[:-1] else chunk)
    joined = carry(chunked, keys, "_chunk", summaries, combine)
    before = F.col("line_top") - F.coalesce(near.previous()["line_bottom"], F.lit(0.0))
    after = F.coalesce(near.following()["line_top"] - F.col("line_bottom"), F.lit(0.0))
    return (
        joined.withColumn("spacing_before", F.bround(F.abs(before), 2))
        .withColumn("spacing_after", F.bround(F.abs(after), 2))
        .drop("_chunk", "_previous_chunk", "_next_chunk")
    )


def with_span_features(spans: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Spans of at least three characters with size, bold, top and spacing to the previous kept span."""
    keys, order = ["doc_id", "page"], ["block_idx", "line_idx", "span_idx"]
    kept = (
        spans.withColumn("text", tx.strip("text"))
        .where(F.char_length("text") >= 3)
        .select(
            *keys,
            *order,
            "text",
            F.bround("size", 1).alias("font_size"),
            tx.bold_from_font("font").alias("bold"),
            F.bround("y0", 1).alias("top"),
        )
    )
    near = Neighbours(keys, "_chunk", order, F.struct("top"))

    def combine(part, w):
        return part.select(*keys, "_chunk", *near.carried(w)).drop("_next_chunk")

    chunked = kept.withColumn("_chunk", F.struct("block_idx", chunk_of("line_idx", rows_per_chunk).alias("lines")))
    joined = carry(chunked, keys, "_chunk", near.summaries, combine)
    gap = F.col("top") - F.coalesce(near.previous()["top"], F.lit(0.0))
    return joined.withColumn("spacing", F.bround(F.abs(gap), 1)).drop("_chunk", "_previous_chunk")
