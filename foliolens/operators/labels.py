"""Label documents, and the joins of their headings to lines and spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.functions.text import SPACE_CLASS, strip
from foliolens.plans.chunks import chunk_of
from foliolens.plans.lineage import cut

# Label vocabularies with their class numbers.
LEVELS = {"BODY": 0, "H1": 1, "H2": 2, "H3": 3}
TEXT_LEVELS = {"Title": 0, "H1": 1, "H2": 2, "H3": 3, "H4": 4, "NotHeading": 5}


def class_of(level: Column | str, vocabulary: dict[str, int] = LEVELS) -> Column:
    level = F.col(level) if isinstance(level, str) else level
    number = None
    for name, value in vocabulary.items():
        number = F.when(level == name, value) if number is None else number.when(level == name, value)
    return number


def level_of(number: Column | str, vocabulary: dict[str, int] = LEVELS) -> Column:
    """Level name of a class number, so that no bare number reaches an outline."""
    number = F.col(number) if isinstance(number, str) else number
    name = None
    for label, value in vocabulary.items():
        name = F.when(number == value, label) if name is None else name.when(number == value, label)
    return name


def render_level(value: Column | str) -> Column:
    """Digits n become H{n+1}; every other value is kept as text."""
    value = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(value.rlike("^[0-9]+$"), F.concat(F.lit("H"), (value.cast("int") + 1).cast("string"))).otherwise(value)


def in_vocabulary(entries: DataFrame, vocabulary: dict[str, int] = LEVELS) -> DataFrame:
    return entries.where(F.col("level").isin(list(vocabulary)))


def labelled(documents: DataFrame, labels: DataFrame, need_outline: bool = False) -> DataFrame:
    """Rows of documents that have a label document, optionally one with headings."""
    wanted = labels.where(F.size("outline") > 0) if need_outline else labels
    return documents.join(wanted.select("doc_id"), "doc_id", "left_semi")


def unlabelled(documents: DataFrame, labels: DataFrame, need_outline: bool = False) -> DataFrame:
    wanted = labels.where(F.size("outline") > 0) if need_outline else labels
    return documents.join(wanted.select("doc_id"), "doc_id", "left_anti")


def _match(rows: DataFrame, entries: DataFrame, choose, page_base: int, lower: bool, default: str) -> DataFrame:
    def key(text: str) -> Column:
        """Digest of the text to match, so that a long text does not cross the shuffle twice."""
        return F.sha2(F.lower(strip(text)) if lower else strip(text), 256)

    # One row per key, written out: without the layout of its grouping both sides are shuffled for the join, and Spark splits the
    # rows of a hot key (a line repeated on one page) at run time, where the label side would else have to be repeated for all keys.
    per_key = cut(
        entries.withColumn("_key", key("text"))
        .groupBy("doc_id", (F.col("page") - page_base).alias("page"), "_key")
        .agg(choose("level", "pos").alias("label"))
    )
    joined = rows.withColumn("_key", key("text")).join(per_key, ["doc_id", "page", "_key"], "left")
    return joined.withColumn("label", F.coalesce("label", F.lit(default))).drop("_key")


def label_last(rows: DataFrame, entries: DataFrame, page_base: int = 0, default: str = "BODY") -> DataFrame:
    """Adds the level of the last label with the row's trimmed text and page; `page_base` is the labels' first page."""
    return _match(rows, entries, F.max_by, page_base, False, default)


def label_first(rows: DataFrame, entries: DataFrame, page_base: int = 0, default: str = "BODY") -> DataFrame:
    """Adds the level of the first label with the row's trimmed text and page."""
    return _match(rows, entries, F.min_by, page_base, False, default)


def label_title(lines: DataFrame, titles: DataFrame, entries: DataFrame) -> DataFrame:
    """Title where a word of the lower-cased title is part of the line, else the first matching heading, else NotHeading.

    Title words reach the lines once per chunk of lines, so a document of any size is spread out.  Several titles of
    one document count together.
    """
    words = F.filter(F.split(F.lower(F.coalesce("title", F.lit(""))), f"[{SPACE_CLASS}]+"), lambda w: w != "")
    per_document = titles.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list(words))).alias("_words"))
    headed = _match(lines, entries, F.min_by, 0, True, "NotHeading").withColumn("_chunk", chunk_of("line_idx"))
    present = lines.select("doc_id", chunk_of("line_idx").alias("_chunk")).distinct()
    spread = present.join(per_document, "doc_id", "left")
    joined = headed.join(spread, ["doc_id", "_chunk"], "inner")
    text = F.lower(strip("text"))
    titled = F.exists(F.coalesce("_words", F.array().cast("array<string>")), lambda w: F.contains(text, w))
    return joined.withColumn("label", F.when(titled, "Title").otherwise(F.col("label"))).drop("_words", "_chunk")
