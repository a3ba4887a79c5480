"""Layout rows from tables: plain text documents and page markup.

Plain text carries no layout, so `text_lines` gives each line a nominal place: ten lines to a page,
14 points apart, and a font size by line length.  Everything downstream takes any table
of the same columns.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.functions.text import strip
from foliolens.plans.session import spread

LINES_PER_PAGE = 10
LINES_PER_BLOCK = 5


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_lines(documents: DataFrame, *carried: str) -> DataFrame:
    """Non-blank lines of each document with nominal layout.

    Columns: doc_id, line_idx, text, page, font_size, flags, indent, line_top, line_bottom and `carried`.
    """
    kept = F.filter(F.split("text", "\n"), lambda line: F.trim(line) != "")
    rows = spread(documents.select("doc_id", *carried, "text"), "doc_id").select(
        "doc_id", *carried, F.posexplode(kept).alias("line_idx", "text")
    )
    length = F.char_length("text")
    size = (
        F.when(F.col("line_idx") == 0, 24.0).when(length <= 40, 16.0).when(length <= 100, 14.0).otherwise(11.0)
    )
    row = F.col("line_idx") % LINES_PER_PAGE
    top = (F.lit(72) + 14 * row).cast("double")
    return rows.select(
        "doc_id",
        *carried,
        "line_idx",
        "text",
        F.floor(F.col("line_idx") / LINES_PER_PAGE).cast("int").alias("page"),
        size.alias("font_size"),
        F.when(length <= 40, 16).otherwise(0).alias("flags"),
        (F.lit(72.0) + 6.25 * (F.col("line_idx") % 3)).alias("indent"),
        top.alias("line_top"),
        (top + size).alias("line_bottom"),
    )


SPAN_PATTERN = "([^,.]+[,.]*|[,.]+)"


def text_spans(documents: DataFrame) -> DataFrame:
    """Spans of each line: pieces ending in punctuation, every second one in a bold face; lines are numbered inside blocks of five."""
    pieces = F.regexp_extract_all("text", F.lit(SPAN_PATTERN), F.lit(1))
    spans = text_lines(documents).select("*", F.posexplode(pieces).alias("span_idx", "span_text"))
    odd = F.col("span_idx") % 2 == 1
    return spans.select(
        "doc_id",
        "page",
        F.floor(F.col("line_idx") / LINES_PER_BLOCK).cast("int").alias("block_idx"),
        (F.col("line_idx") % LINES_PER_BLOCK).cast("int").alias("line_idx"),
        "span_idx",
        F.col("span_text").alias("text"),
        (F.col("font_size") - F.when(odd, 1.5).otherwise(0.0)).alias("size"),
        F.when(odd | (F.col("font_size") >= 16), "Serif-Bold").otherwise("Serif").alias("font"),
        F.when(odd, F.col("flags") + 2).otherwise(F.col("flags")).alias("flags"),
        (F.col("indent") + 3.0 * F.col("span_idx")).alias("origin_x"),
        F.col("indent").alias("x0"),
        F.col("line_top").alias("y0"),
        F.col("line_bottom").alias("y1"),
    )


# Font size of text that follows each opening tag; other text is body size.
TAG_SIZES = {"h1": 24.0, "h2": 18.0, "h3": 16.0, "h4": 14.0, "b": 12.0, "strong": 12.0, "li": 10.0, "a": 10.0}
BODY_SIZE = 11.0
HIDDEN_MARKUP = "(?is)<head[^>]*>.*?</head>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
# A tag, with `>` allowed inside quoted values; where quotes do not close, up to the next `>`.
TAG_PATTERN = "(?:<(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|<[^>]*>)"
RUN_PATTERN = f"({TAG_PATTERN}[^<]*)"
REFERENCE = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
REFERENCES = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}


def _decode(text: Column) -> Column:
    """Text with named and numeric character references decoded once; unknown names stay, impossible numbers become U+FFFD."""
    names = F.from_json(F.lit(json.dumps(REFERENCES)), "map<string,string>")

    def one(reference: Column) -> Column:
        base = F.when(F.lower(reference).startswith("&#x"), F.lit(16)).otherwise(F.lit(10))
        digits = F.regexp_replace(reference, "^&#[xX]?|;$", "")
        code = F.when(base == 16, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        numeric = F.when(F.coalesce(valid, F.lit(False)), point).otherwise(F.lit("\ufffd"))
        return F.when(reference.startswith("&#"), numeric).otherwise(F.coalesce(names[reference], reference))

    between = F.split(text, REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), one)
    joined = F.array_join(F.zip_with(between, decoded, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def markup_blocks(pages: DataFrame) -> DataFrame:
    """Text runs of each page in order, sized by the tag they follow.

    Columns: doc_id (from page_id), block_idx, tag, text, font_size, x0, y0, page.  Text before the
    first tag forms a run of its own, and head, scripts, styles and comments are not text.
    """
    visible = F.concat(F.lit("<body>"), F.regexp_replace("html", HIDDEN_MARKUP, ""))
    runs = F.regexp_extract_all(visible, F.lit(RUN_PATTERN), F.lit(1))
    parsed = F.transform(
        runs,
        lambda run: F.struct(
            F.lower(F.regexp_extract(run, "^<(/?[a-zA-Z0-9]*)", 1)).alias("tag"),
            strip(_decode(F.regexp_replace(run, f"^{TAG_PATTERN}", ""))).alias("text"),
        ),
    )
    kept = F.filter(parsed, lambda run: run["text"] != "")
    rows = spread(pages.select(F.col("page_id").alias("doc_id"), "html"), "doc_id").select(
        "doc_id", F.posexplode(kept).alias("block_idx", "run")
    )
    size = None
    for tag, points in TAG_SIZES.items():
        hit = F.col("run.tag") == tag
        size = F.when(hit, points) if size is None else size.when(hit, points)
    return rows.select(
        "doc_id",
        "block_idx",
        F.col("run.tag").alias("tag"),
        F.col("run.text").alias("text"),
        size.otherwise(BODY_SIZE).alias("font_size"),
        F.lit(72.0).alias("x0"),
        (F.lit(720.0) - 14.0 * (F.col("block_idx") % 40)).alias("y0"),
        (F.floor(F.col("block_idx") / 40) + 1).cast("int").alias("page"),
    )
