"""File sources: document folders, label files, raw line files and collection configs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.sources.schemas import COLLECTION_SCHEMA, LINE_SCHEMA, OUTLINE_SCHEMA

ANY_CASE = "*.[pP][dD][fF]"
LOWER_CASE = "*.pdf"


def list_documents(spark: SparkSession, folder: str, any_case: bool = True) -> DataFrame:
    """PDF files of a folder: doc_id (name without suffix), path, length and modification time; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", ANY_CASE if any_case else LOWER_CASE).load(folder)
    return files.select(
        base_name(F.col("path"), "\\.[pP][dD][fF]").alias("doc_id"),
        "path",
        "length",
        F.col("modificationTime").alias("modified"),
    )


def base_name(path: Column, suffix: str) -> Column:
    name = F.url_decode(F.replace(F.regexp_extract(path, "([^/]*)$", 1), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, f"{suffix}$", "")


def read_label_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """Label documents of a folder, one JSON object per file, and the files that do not parse.

    The first table has doc_id, title and outline; a missing outline is empty.  The second has doc_id and content.
    """
    texts = (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select(base_name(F.col("_metadata.file_path"), "\\.json").alias("_name"), "value")
        .where(~F.col("_name").endswith("_raw"))
    )
    return _parse_labels(texts, F.col("_name"))


def read_label_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The same for label documents stored many to a file, one per line, each with its doc_id."""
    return _parse_labels(spark.read.text(folder), F.col("_parsed.doc_id"))


def _parse_labels(texts: DataFrame, name: Column) -> tuple[DataFrame, DataFrame]:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = texts.withColumn("_parsed", F.from_json("value", f"doc_id string, {OUTLINE_SCHEMA}, _broken string", options))
    broken = F.col("_parsed").isNull() | F.col("_parsed._broken").isNotNull()
    good = parsed.where(~broken).select(
        name.alias("doc_id"),
        F.coalesce("_parsed.title", F.lit("")).alias("title"),
        F.coalesce("_parsed.outline", F.array()).alias("outline"),
    )
    return good, parsed.where(broken).select(name.alias("doc_id"), F.col("value").alias("content"))


def outline_entries(labels: DataFrame) -> DataFrame:
    """One row per labelled heading: doc_id, pos, level, text, page."""
    return labels.select("doc_id", F.posexplode("outline").alias("pos", "entry")).select(
        "doc_id", "pos", "entry.level", "entry.text", "entry.page"
    )


def read_raw_lines(spark: SparkSession, folder: str, pattern: str = "*_raw.json", by_folder: bool = False) -> DataFrame:
    """Line records of the `*_raw.json` files of a folder, each a JSON array; absent numbers stay null.

    The file's name gives doc_id or, with `by_folder`, the name of the folder of each document, as a partitioned writer makes it.

    Reading order inside a file becomes line_idx: one file is one task's input, so its rows
    come in file order with growing ids.
    """
    rows = (
        spark.read.schema(LINE_SCHEMA)
        .option("multiLine", True)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", by_folder)
        .json(folder)
    )
    path = F.col("_metadata.file_path")
    named = F.regexp_extract(path, "([^/=]*)/[^/]*$", 1) if by_folder else base_name(path, "_raw\\.json")
    rows = rows.withColumn("doc_id", named)
    return rows.withColumn("line_idx", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, folder: str, doc_id: str = "long") -> DataFrame:
    """Line records stored many documents to a file, as the line sink writes them."""
    fields = [f"{field.name} {field.dataType.simpleString()}" for field in LINE_SCHEMA.fields]
    return spark.read.schema(", ".join([f"doc_id {doc_id}", "line_idx int", *fields])).json(folder)


def read_outlines(spark: SparkSession, folder: str, doc_id: str = "long") -> DataFrame:
    return spark.read.schema(f"doc_id {doc_id}, part int, {OUTLINE_SCHEMA}").json(folder)


def read_collections(spark: SparkSession, folder: str, pattern: str = "*input.json") -> DataFrame:
    """Collection configs below a folder: collection, persona, job, and the document names; absent keys give ''."""
    rows = (
        spark.read.schema(COLLECTION_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(folder)
        .withColumn("path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    )
    return rows.select(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("collection"), *collection_columns())


def collection_columns() -> list[Column]:
    return [
        F.coalesce("persona.role", F.lit("")).alias("persona"),
        F.coalesce("job_to_be_done.task", F.lit("")).alias("job"),
        F.coalesce(F.transform("documents", lambda d: d["filename"]), F.array().cast("array<string>")).alias("documents"),
    ]
