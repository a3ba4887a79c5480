"""Registry of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.operators import lines as ln
from foliolens.operators import outline as ol
from foliolens.plans.session import configure
from foliolens.sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, and the layout rows that the queries derive from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def read(self, name: str) -> DataFrame:
        return tb.read(self.spark, self.folder, name)

    @cached_property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @cached_property
    def lines(self) -> DataFrame:
        return tb.text_lines(self.documents)

    @cached_property
    def features(self) -> DataFrame:
        return ln.with_line_features(self.lines, words=False)

    @cached_property
    def all_features(self) -> DataFrame:
        return ln.with_line_features(self.lines)

    @cached_property
    def spans(self) -> DataFrame:
        return tb.text_spans(self.documents)

    @cached_property
    def blocks(self) -> DataFrame:
        """Each line of text as a block."""
        return self.lines.select("doc_id", F.col("line_idx").alias("block_idx"), "text", "font_size", "page")

    @cached_property
    def sections(self) -> DataFrame:
        """Each line of text as a section, with the collection (source) of its document."""
        rows = tb.text_lines(self.documents, "source")
        return rows.select(
            "doc_id", F.col("line_idx").alias("section_idx"), F.col("source").alias("collection"), "text", "page"
        )

    @cached_property
    def configs(self) -> DataFrame:
        """One persona and job per collection: its name, and the first user turn of the conversation of its number."""
        asked = self.read("conversations").where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("job"))
        sources = self.documents.select(F.col("source").alias("collection")).distinct()
        number = F.expr("try_cast(substring(collection, 4) AS bigint)")
        joined = sources.withColumn("conv_id", number).join(asked, "conv_id", "left")
        return joined.select("collection", F.col("collection").alias("persona"), F.coalesce("job", F.lit("")).alias("job"))

    @cached_property
    def labels(self) -> DataFrame:
        """Label documents of the documents with quality 1.

        Title: the first two words.  Headings: the first line as H1, lines of up to 40 characters as H2 and, where
        at most 20 long, once more as H3 (a duplicate key) or, at most 8 long, as H4.
        """
        good = self.read("labels").where("quality = 1").select("doc_id")
        kept = F.filter(F.split("text", "\n"), lambda line: F.trim(line) != "")
        place = F.transform(kept, lambda line, i: F.struct(i.alias("i"), line.alias("t")))

        def entry(level: str, item):
            page = F.floor(item["i"] / tb.LINES_PER_PAGE).cast("int")
            return F.struct(F.lit(level).alias("level"), item["t"].alias("text"), page.alias("page"))

        first = F.transform(F.filter(place, lambda p: p["i"] == 0), lambda p: entry("H1", p))
        short = F.filter(place, lambda p: F.char_length(p["t"]) <= 40)
        second = F.transform(short, lambda p: entry("H2", p))
        third = F.transform(
            F.filter(short, lambda p: (F.char_length(p["t"]) <= 20) & (F.char_length(p["t"]) > 8)),
            lambda p: entry("H3", p),
        )
        fourth = F.transform(F.filter(short, lambda p: F.char_length(p["t"]) <= 8), lambda p: entry("H4", p))
        title = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit("([^ \\n]+)"), F.lit(1)), 1, 2))
        return self.documents.join(good, "doc_id", "left_semi").select(
            "doc_id", title.alias("title"), F.concat(first, second, third, fourth).alias("outline")
        )

    @cached_property
    def entries(self) -> DataFrame:
        return self.labels.select("doc_id", F.posexplode("outline").alias("pos", "e")).select("doc_id", "pos", "e.*")

    @cached_property
    def predicted(self) -> DataFrame:
        """Merged candidates with a level by font size."""
        from foliolens.operators.candidates import candidates

        return candidates(self.features).withColumn("level", ol.level_by_size())


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return build

    return register


# --- Shared parts of the SQL counterparts -------------------------------------------------------

WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^[{WS}]+', ''), '[{WS}]+$', '')"


def sql_collapse(x: str) -> str:
    return sql_strip(rf"regexp_replace({x}, '[{WS}]{{2,}}', ' ', 'g')")


def sql_words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^{WS}]+'))::INTEGER"


CONFIGS = """
configs AS (
  SELECT collection, collection AS persona, coalesce(job, '') AS job
  FROM (SELECT DISTINCT source AS collection FROM documents)
  LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS job FROM conversations WHERE role = 'user' GROUP BY conv_id)
    ON conv_id = try_cast(substr(collection, 4) AS BIGINT)
)"""

LINES = """
raw_lines AS (
  SELECT doc_id, source, unnest(ls) AS text, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_idx
  FROM (SELECT doc_id, source, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents)
),
lines AS (
  SELECT doc_id, source, line_idx, text, (line_idx // 10)::INTEGER AS page, font_size,
         (CASE WHEN length(text) <= 40 THEN 16 ELSE 0 END)::INTEGER AS flags,
         72.0::DOUBLE + 6.25::DOUBLE * (line_idx % 3) AS indent,
         line_top, line_top + font_size AS line_bottom
  FROM (SELECT *, (72 + 14 * (line_idx % 10))::DOUBLE AS line_top,
               (CASE WHEN line_idx = 0 THEN 24 WHEN length(text) <= 40 THEN 16 WHEN length(text) <= 100 THEN 14
                     ELSE 11 END)::DOUBLE AS font_size
        FROM raw_lines)
)"""

FEATURES = (
    LINES
    + rf""",
features AS (
  SELECT doc_id, line_idx, page, font_size, flags, indent, line_top, line_bottom, text,
         (CASE WHEN (flags & 2) > 0 THEN 1 ELSE 0 END)::INTEGER AS bold,
         length(text)::INTEGER AS length,
         (CASE WHEN regexp_matches(text, '\p{{Lu}}') AND NOT regexp_matches(text, '[\p{{Ll}}\p{{Lt}}]') THEN 1 ELSE 0 END)::INTEGER AS is_upper,
         (CASE WHEN text LIKE '%:' THEN 1 ELSE 0 END)::INTEGER AS ends_with_colon,
         (CASE WHEN {sql_words('text')} <= 8 THEN 1 ELSE 0 END)::INTEGER AS is_short,
         (CASE WHEN regexp_matches(text, '^[0-9]') THEN 1 ELSE 0 END)::INTEGER AS is_numbered,
         (CASE WHEN page = 0 THEN 1 ELSE 0 END)::INTEGER AS first_page,
         {sql_words('text')} AS num_words
  FROM (SELECT * REPLACE ({sql_collapse('text')} AS text) FROM lines)
  WHERE regexp_matches(text, '[A-Za-z0-9]')
)"""
)

CONTEXT = (
    FEATURES
    + """,
context AS (
  SELECT *,
         round_even(abs(line_top - coalesce(lag(line_bottom) OVER p, 0)), 2) AS spacing_before,
         round_even(abs(coalesce(lead(line_top) OVER p - line_bottom, 0)), 2) AS spacing_after,
         CASE WHEN min(font_size) OVER w = max(font_size) OVER w THEN min(font_size) OVER w
              ELSE avg(font_size) OVER w END AS page_mean,
         CASE WHEN min(font_size) OVER w = max(font_size) OVER w THEN 0
              ELSE coalesce(stddev_samp(font_size) OVER w, 0) END AS page_std,
         max(line_bottom) OVER w AS page_bottom,
         last_value(text) OVER (PARTITION BY doc_id, page ORDER BY line_top, line_idx
                                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS page_last_text,
         count(*) OVER (PARTITION BY doc_id, lower(text), round_even(line_top, 1)) AS repeats
  FROM features
  WINDOW p AS (PARTITION BY doc_id, page ORDER BY line_idx), w AS (PARTITION BY doc_id, page)
)"""
)

FILTERED = (
    CONTEXT
    + r""",
filtered AS (
  SELECT * FROM context
  WHERE text <> page_last_text AND repeats < 3
    AND length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) >= 3
    AND length <= 100 AND num_words <= 15
    AND font_size >= page_mean + 0.25::DOUBLE * page_std - 1e-9
)"""
)

MERGED = (
    FILTERED
    + """,
marked AS (
  SELECT *, CASE WHEN row(font_size, bold, is_upper, ends_with_colon, is_short, is_numbered, first_page)
                      IS NOT DISTINCT FROM
                      lag(row(font_size, bold, is_upper, ends_with_colon, is_short, is_numbered, first_page)) OVER o
                 THEN 0 ELSE 1 END AS starts
  FROM filtered WINDOW o AS (PARTITION BY doc_id, page ORDER BY line_top, line_idx)
),
runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY doc_id, page ORDER BY line_top, line_idx) AS run FROM marked
),
merged AS (
  SELECT doc_id, page, arg_min(line_idx, (line_top, line_idx)) AS line_idx,
         string_agg(text, ' ' ORDER BY line_top, line_idx) AS text,
         sum(length)::INTEGER AS length, sum(num_words)::INTEGER AS num_words,
         min(line_top) AS line_top, max(line_bottom) AS line_bottom,
         min(font_size) AS font_size, min(bold) AS bold, min(is_upper) AS is_upper,
         min(ends_with_colon) AS ends_with_colon, min(is_short) AS is_short, min(is_numbered) AS is_numbered,
         min(first_page) AS first_page, arg_min(indent, (line_top, line_idx)) AS indent,
         arg_min(spacing_before, (line_top, line_idx)) AS spacing_before,
         arg_min(spacing_after, (line_top, line_idx)) AS spacing_after
  FROM runs GROUP BY doc_id, page, run
)"""
)

PREDICTED = (
    MERGED
    + """,
predicted AS (
  SELECT *, CASE WHEN font_size >= 20 THEN 'H1' WHEN font_size >= 15 THEN 'H2' WHEN font_size >= 13 THEN 'H3'
                 ELSE 'BODY' END AS level
  FROM merged
)"""
)

TRUTH = """
good AS (
  SELECT d.doc_id, d.text, list_filter(string_split(d.text, chr(10)), lambda x: trim(x) <> '') AS ls
  FROM documents d SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) g ON d.doc_id = g.doc_id
),
titles AS (
  SELECT doc_id, array_to_string(list_slice(regexp_extract_all(text, '[^ \\n]+'), 1, 2), ' ') AS title FROM good
),
good_lines AS (
  SELECT doc_id, unnest(ls) AS text, (generate_subscripts(ls, 1) - 1)::INTEGER AS i FROM good
),
entries AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY kind, i) - 1)::INTEGER AS pos, level, text,
         (i // 10)::INTEGER AS page
  FROM (SELECT *, 1 AS kind, 'H1' AS level FROM good_lines WHERE i = 0
        UNION ALL SELECT *, 2, 'H2' FROM good_lines WHERE length(text) <= 40
        UNION ALL SELECT *, 3, 'H3' FROM good_lines WHERE length(text) BETWEEN 9 AND 20
        UNION ALL SELECT *, 4, 'H4' FROM good_lines WHERE length(text) <= 8)
)"""
