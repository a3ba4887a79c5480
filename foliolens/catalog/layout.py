"""Scans, line and block extraction, line features and spacing."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foliolens.catalog.base import CONTEXT, FEATURES, LINES, WS, Tables, query, sql_collapse, sql_strip
from foliolens.functions import text as tx
from foliolens.operators import lines as ln
from foliolens.operators import tagging
from foliolens.operators.training import LAYOUT_FEATURES, LINE_FEATURES, filled
from foliolens.sources import tables as tb

SPANS = (
    LINES
    + """,
spans AS (
  SELECT doc_id, page, (line_idx // 5)::INTEGER AS block_idx, (line_idx % 5)::INTEGER AS line_idx, span_idx, piece AS text,
         font_size - CASE WHEN span_idx % 2 = 1 THEN 1.5 ELSE 0 END::DOUBLE AS size,
         CASE WHEN span_idx % 2 = 1 OR font_size >= 16 THEN 'Serif-Bold' ELSE 'Serif' END AS font,
         (flags + CASE WHEN span_idx % 2 = 1 THEN 2 ELSE 0 END)::INTEGER AS flags,
         indent + 3::DOUBLE * span_idx AS origin_x, indent AS x0, line_top AS y0, line_bottom AS y1
  FROM (SELECT *, unnest(ps) AS piece, (generate_subscripts(ps, 1) - 1)::INTEGER AS span_idx
        FROM (SELECT *, regexp_extract_all(text, '[^,.]+[,.]*|[,.]+') AS ps FROM lines))
)"""
)


def _tag_case(word: str) -> str:
    parts = [f"WHEN regexp_matches({word}, '^[0-9]+$') THEN 'CD'"]
    for tag, words in tx.LEXICON.items():
        listed = ", ".join(f"'{w}'" for w in words)
        parts.append(f"WHEN {word} IN ({listed}) THEN '{tag}'")
    parts += [f"WHEN ends_with({word}, '{ending}') THEN '{tag}'" for ending, tag in tx.SUFFIXES]
    return "CASE " + " ".join(parts) + " ELSE 'NN' END"


def _class_counts() -> str:
    columns = []
    for name, tags in tx.TAG_CLASSES.items():
        listed = ", ".join(f"'{t}'" for t in tags)
        columns.append(f"len(list_filter(tags, lambda t: t IN ({listed})))::INTEGER AS {name}")
    return ", ".join(columns)


POS = (
    CONTEXT
    + rf""",
pos AS (
  SELECT * EXCLUDE (tags), {_class_counts()}
  FROM (SELECT *, list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), lambda w: {_tag_case('w')}) AS tags
        FROM context)
)"""
)


@query("src_documents", "SELECT doc_id, lang, source, n_chars, strlen(text)::BIGINT AS n_bytes FROM documents")
def src_documents(t: Tables):
    return t.documents.select("doc_id", "lang", "source", "n_chars", F.octet_length("text").cast("long").alias("n_bytes"))


@query(
    "line_extract",
    "WITH "
    + SPANS
    + rf"""
SELECT doc_id, page, block_idx, line_idx, text, font_size, flags, indent, line_top, line_bottom
FROM (SELECT doc_id, page, block_idx, line_idx, {sql_collapse("string_agg(text, '' ORDER BY span_idx)")} AS text,
             arg_min(size, span_idx) AS font_size, arg_min(flags, span_idx) AS flags,
             round_even(arg_min(origin_x, span_idx), 2) AS indent, min(y0) AS line_top, max(y1) AS line_bottom
      FROM spans GROUP BY doc_id, page, block_idx, line_idx)
WHERE regexp_matches(text, '[A-Za-z0-9]')""",
)
def line_extract(t: Tables):
    return ln.lines_from_spans(t.spans)


@query(
    "block_extract",
    "WITH "
    + SPANS
    + rf""",
per_line AS (
  SELECT doc_id, page, block_idx, line_idx, string_agg(text, '' ORDER BY span_idx) AS line_text,
         sum(size * length(text)) AS points, sum(length(text)) AS characters, min(x0) AS x0, min(y0) AS y0
  FROM spans GROUP BY doc_id, page, block_idx, line_idx
)
SELECT doc_id, page, block_idx, text, round(font_size, 4) AS font_size, x0, y0
FROM (SELECT doc_id, page + 1 AS page, block_idx, {sql_strip("string_agg(line_text, chr(10) ORDER BY line_idx)")} AS text,
             sum(points) / sum(characters) AS font_size, min(x0) AS x0, min(y0) AS y0
      FROM per_line GROUP BY doc_id, page, block_idx)
WHERE text <> ''""",
)
def block_extract(t: Tables):
    return ln.blocks_from_spans(t.spans).withColumn("font_size", F.round("font_size", 4))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NAMES = ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in tb.REFERENCES.items())
POINT = "CASE WHEN code BETWEEN 1 AND 1114111 AND code NOT BETWEEN 55296 AND 57343 THEN chr(code) ELSE chr(65533) END"
CODE = (
    "CASE WHEN lower(m) LIKE '&#x%' THEN try_cast('0x' || substr(m, 4, length(m) - 4) AS INTEGER)"
    " WHEN m LIKE '&#%' THEN try_cast(substr(m, 3, length(m) - 3) AS INTEGER) END"
)

BLOCKS = rf"""
names AS (SELECT MAP {{{NAMES}}} AS named),
visible AS (
  SELECT page_id, '<body>' || regexp_replace(html, '{tb.HIDDEN_MARKUP}', '', 'g') AS html FROM pages
),
runs AS (
  SELECT page_id AS doc_id, unnest(rs) AS r, generate_subscripts(rs, 1) AS i
  FROM (SELECT page_id, regexp_extract_all(html, {_quoted(tb.RUN_PATTERN)}) AS rs FROM visible)
),
cut AS (
  SELECT doc_id, i, lower(regexp_extract(r, '^<(/?[a-zA-Z0-9]*)', 1)) AS tag, regexp_replace(r, {_quoted("^" + tb.TAG_PATTERN)}, '') AS raw
  FROM runs
),
marked AS (SELECT *, string_split_regex(raw, '{tb.REFERENCE}') AS ps, regexp_extract_all(raw, '{tb.REFERENCE}') AS ms FROM cut),
parts AS (
  SELECT doc_id, i, tag, k, ps[k] AS p, ms[k] AS m FROM (SELECT *, unnest(range(1, len(ps) + 1)) AS k FROM marked)
),
coded AS (SELECT *, {CODE} AS code FROM parts),
decoded AS (
  SELECT doc_id, i, tag,
         {sql_strip("string_agg(p || CASE WHEN m IS NULL THEN '' WHEN m LIKE '&#%' THEN " + POINT + " ELSE coalesce(map_extract(named, m)[1], m) END, '' ORDER BY k)")} AS text
  FROM coded, names GROUP BY ALL
),
page_blocks AS (
  SELECT doc_id, block_idx, tag, text,
         (CASE tag WHEN 'h1' THEN 24 WHEN 'h2' THEN 18 WHEN 'h3' THEN 16 WHEN 'h4' THEN 14 WHEN 'b' THEN 12
               WHEN 'strong' THEN 12 WHEN 'li' THEN 10 WHEN 'a' THEN 10 ELSE 11 END)::DOUBLE AS font_size,
         72::DOUBLE AS x0, (720 - 14 * (block_idx % 40))::DOUBLE AS y0, (block_idx // 40 + 1)::INTEGER AS page
  FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS block_idx FROM decoded WHERE text <> '')
)"""


@query("page_blocks", "WITH " + BLOCKS + " SELECT * FROM page_blocks")
def page_blocks(t: Tables):
    return tb.markup_blocks(t.read("pages"))


@query("feat_text", "WITH " + LINES + rf" SELECT doc_id, line_idx, {sql_collapse('text')} AS text FROM lines")
def feat_text(t: Tables):
    return t.lines.select("doc_id", "line_idx", tx.collapse("text").alias("text"))


@query(
    "feat_bold",
    "WITH "
    + SPANS
    + """ SELECT doc_id, line_idx, span_idx, (CASE WHEN (flags & 2) > 0 THEN 1 ELSE 0 END)::INTEGER AS bold_flag,
      (CASE WHEN regexp_matches(lower(font), 'bold|black') THEN 1 ELSE 0 END)::INTEGER AS bold_font FROM spans""",
)
def feat_bold(t: Tables):
    return t.spans.select(
        "doc_id",
        "line_idx",
        "span_idx",
        tx.bold_from_flags("flags").alias("bold_flag"),
        tx.bold_from_font("font").alias("bold_font"),
    )


@query("feat_counts", "WITH " + FEATURES + " SELECT doc_id, line_idx, length, num_words FROM features")
def feat_counts(t: Tables):
    return t.features.select("doc_id", "line_idx", "length", "num_words")


FLAGS = ["doc_id", "line_idx", "is_upper", "ends_with_colon", "is_short", "is_numbered", "first_page", "page"]


@query("feat_flags", "WITH " + FEATURES + f" SELECT {', '.join(FLAGS)} FROM features")
def feat_flags(t: Tables):
    return t.features.select(*FLAGS)


@query("feat_layout", "WITH " + LINES + " SELECT doc_id, line_idx, round_even(indent, 2) AS indent, line_top, line_bottom FROM lines")
def feat_layout(t: Tables):
    return t.lines.select("doc_id", "line_idx", F.bround("indent", 2).alias("indent"), "line_top", "line_bottom")


SPAN_FEATURES_SQL = (
    SPANS
    + rf""",
kept_spans AS (
  SELECT doc_id, page, block_idx, line_idx, span_idx, {sql_strip('text')} AS text, round_even(size, 1) AS font_size,
         (CASE WHEN regexp_matches(lower(font), 'bold|black') THEN 1 ELSE 0 END)::INTEGER AS bold,
         round_even(y0, 1) AS top
  FROM spans WHERE length({sql_strip('text')}) >= 3
),
span_features AS (
  SELECT *, round_even(abs(top - coalesce(lag(top) OVER (PARTITION BY doc_id, page ORDER BY block_idx, line_idx, span_idx), 0)), 1)
            AS spacing
  FROM kept_spans
)"""
)


@query("span_features", "WITH " + SPAN_FEATURES_SQL + " SELECT * FROM span_features")
def span_features(t: Tables):
    return ln.with_span_features(t.spans)


@query("pos_counts", "WITH " + POS + f" SELECT doc_id, line_idx, {', '.join(tx.TAG_CLASSES)} FROM pos")
def pos_counts(t: Tables):
    return t.all_features.select("doc_id", "line_idx", *tx.TAG_CLASSES)


@query("pos_tagged")
def pos_tagged(t: Tables):
    """Word classes of every line by the trained tagger; no SQL counterpart, tests hold its decoding against brute force."""
    tagger = tagging.Tagger.fit(tagging.corpus(t.spark))
    lines = t.features.select("doc_id", "line_idx", "text")  # what goes through Python and back
    return tagging.with_tag_counts(lines, tagger).select("doc_id", "line_idx", *tx.TAG_CLASSES)


@query("spacing", "WITH " + CONTEXT + " SELECT doc_id, page, line_idx, spacing_before, spacing_after FROM context")
def spacing(t: Tables):
    return ln.with_page_context(t.features).select("doc_id", "page", "line_idx", "spacing_before", "spacing_after")


STATS = "doc_id, page, line_idx, round(page_mean, 6) AS page_mean, round(page_std, 6) AS page_std, page_bottom, page_last_text"


@query("page_stats", "WITH " + CONTEXT + f" SELECT {STATS} FROM context")
def page_stats(t: Tables):
    return ln.with_page_context(t.features).select(
        "doc_id",
        "page",
        "line_idx",
        F.round("page_mean", 6).alias("page_mean"),
        F.round("page_std", 6).alias("page_std"),
        "page_bottom",
        "page_last_text",
    )


def _vector(rows, names):
    assembled = VectorAssembler(inputCols=names, outputCol="v", handleInvalid="keep").transform(filled(rows, names))
    values = assembled.select("doc_id", "line_idx", vector_to_array("v").alias("a"))
    return values.select("doc_id", "line_idx", *[F.col("a")[i].alias(f"v{i}") for i in range(len(names))])


@query(
    "layout_vec",
    "WITH " + CONTEXT + " SELECT doc_id, line_idx, "
    + ", ".join(f"{n}::DOUBLE AS v{i}" for i, n in enumerate(LAYOUT_FEATURES)) + " FROM context",
)
def layout_vec(t: Tables):
    return _vector(ln.with_page_context(t.features), LAYOUT_FEATURES)


@query(
    "feature_vec",
    "WITH " + POS + " SELECT doc_id, line_idx, "
    + ", ".join(f"{n}::DOUBLE AS v{i}" for i, n in enumerate(LINE_FEATURES)) + " FROM pos",
)
def feature_vec(t: Tables):
    return _vector(ln.with_page_context(t.all_features), LINE_FEATURES)


@query(
    "title_clean",
    "WITH "
    + LINES
    + rf""",
squeezed AS (SELECT doc_id, line_idx, {sql_strip(f"regexp_replace(text, '[{WS}]+', ' ', 'g')")} AS t FROM lines)
SELECT doc_id, line_idx,
       CASE WHEN length(t) <= 100 THEN t
            WHEN instr(t, '.') BETWEEN 2 AND 100 THEN substr(t, 1, instr(t, '.'))
            ELSE regexp_replace(substr(t, 1, 100), '[{WS}]+$', '') || '...' END AS title
FROM squeezed""",
)
def title_clean(t: Tables):
    return t.lines.select("doc_id", "line_idx", tx.clean_title("text").alias("title"))
