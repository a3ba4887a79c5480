"""Titles and outlines from predicted levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.plans.lineage import salted_join

PAGES_PER_PART = 1_000
READING_ORDER = ["page", "line_top", "line_idx"]
SPAN_ORDER = ["page", "block_idx", "line_idx", "span_idx"]


def level_by_size(h1: float = 20.0, h2: float = 15.0, h3: float = 13.0) -> Column:
    """Rule in place of a trained model: the level by font size."""
    size = F.col("font_size")
    return F.when(size >= h1, "H1").when(size >= h2, "H2").when(size >= h3, "H3").otherwise("BODY")


def outline_rows(predicted: DataFrame, body: str = "BODY") -> DataFrame:
    return predicted.where(F.col("level") != body)


def span_titles(spans: DataFrame, min_size: float = 15.0) -> DataFrame:
    """First bold span of the first page with at least `min_size` points per document, else "Untitled"."""
    fits = (F.col("page") == 0) & (F.col("font_size") >= min_size) & (F.col("bold") == 1)
    first = F.min_by(F.when(fits, F.col("text")), F.when(fits, F.struct("block_idx", "line_idx", "span_idx")))
    return spans.groupBy("doc_id").agg(F.coalesce(first, F.lit("Untitled")).alias("title"))


def promoted_titles(rows: DataFrame) -> DataFrame:
    """Text of the first H1 on page 0 of each document that has one."""
    first_page = rows.where((F.col("level") == "H1") & (F.col("page") == 0))
    return first_page.groupBy("doc_id").agg(F.min_by("text", F.struct(*READING_ORDER)).alias("title"))


def promote_title(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Titles, and the outline rows without those equal to the title row in level, text and page."""
    titles = promoted_titles(rows)
    same = titles.select("doc_id", F.lit("H1").alias("level"), F.lit(0).alias("page"), F.col("title").alias("text"))
    rest = salted_join(rows, same, ["doc_id", "level", "page", "text"], "left_anti", salt="line_idx")
    return titles, rest


def first_title_prediction(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Title from the first row predicted Title; later such rows stay in the outline."""
    order = F.struct(*READING_ORDER)
    titles = rows.where(F.col("level") == "Title").groupBy("doc_id").agg(
        F.min_by(F.struct("text", *READING_ORDER), order).alias("_row")
    )
    used = titles.select("doc_id", *[F.col(f"_row.{c}").alias(c) for c in READING_ORDER])
    rest = rows.join(used, ["doc_id", *READING_ORDER], "left_anti")
    return titles.select("doc_id", F.col("_row.text").alias("title")), rest


def outline_documents(
    documents: DataFrame,
    titles: DataFrame,
    rows: DataFrame,
    per_part: int = PAGES_PER_PART,
    page_base: int = 0,
    order: list[str] = READING_ORDER,
) -> DataFrame:
    """doc_id, part, title and outline[level, text, page], one row per document and part that has headings.

    A part is a range of `per_part` pages, so that no task has to hold all headings of a huge document; every document
    has part 0, and every part its title.  Pages are numbered from `page_base` in the outline.
    """
    entry = F.struct(*order, "level", "text")
    part = F.floor(F.col("page") / per_part).cast("int").alias("part")
    lists = rows.groupBy("doc_id", part).agg(
        F.transform(
            F.array_sort(F.collect_list(entry)),
            lambda e: F.struct(e["level"].alias("level"), e["text"].alias("text"), (e["page"] + page_base).alias("page")),
        ).alias("outline")
    )
    headed = documents.select("doc_id").join(titles, "doc_id", "left")
    first = headed.withColumn("part", F.lit(0))
    later = lists.where("part > 0").select("doc_id", "part").join(headed, "doc_id").select(*first.columns)
    return first.unionByName(later).join(lists, ["doc_id", "part"], "left").select(
        "doc_id",
        "part",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("outline", F.array()).alias("outline"),
    )
