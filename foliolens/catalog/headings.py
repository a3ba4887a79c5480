"""Candidate filters, run merging, labels, titles and outlines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliolens.catalog.base import CONTEXT, FEATURES, LINES, MERGED, PREDICTED, TRUTH, Tables, query, sql_strip
from foliolens.catalog.layout import SPAN_FEATURES_SQL
from foliolens.operators import candidates as cd
from foliolens.operators import labels as lb
from foliolens.operators import lines as ln
from foliolens.operators import outline as ol
from foliolens.operators import training as tr
from foliolens.plans import outline_flow as flow
from foliolens.plans.lineage import cut, scratch
from foliolens.sources import files, sinks
from foliolens.sources.schemas import LINE_NAMES

KEY = ["doc_id", "page", "line_idx", "text"]


@query("filter_footer", "WITH " + CONTEXT + " SELECT doc_id, page, line_idx, text FROM context WHERE text <> page_last_text")
def filter_footer(t: Tables):
    return ln.with_page_context(t.features).where(cd.not_page_last()).select(*KEY)


@query("filter_repeats", "WITH " + CONTEXT + " SELECT doc_id, page, line_idx, text FROM context WHERE repeats < 3")
def filter_repeats(t: Tables):
    return cd.drop_repeats(t.features).select(*KEY)


@query(
    "filter_basic",
    "WITH "
    + FEATURES
    + r""" SELECT doc_id, page, line_idx, text FROM features
      WHERE length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) >= 3 AND length <= 100 AND num_words <= 15""",
)
def filter_basic(t: Tables):
    return t.features.where(cd.short_enough()).select(*KEY)


@query(
    "filter_font_z",
    "WITH "
    + CONTEXT
    + " SELECT doc_id, page, line_idx, text FROM context WHERE font_size >= page_mean + 0.25::DOUBLE * page_std - 1e-9",
)
def filter_font_z(t: Tables):
    return ln.with_page_context(t.features).where(cd.large_enough()).select(*KEY)


MERGED_COLUMNS = [
    "doc_id", "page", "line_idx", "text", "font_size", "bold", "length", "is_upper", "indent", "line_top", "line_bottom",
    "spacing_before", "spacing_after", "ends_with_colon", "is_short", "is_numbered", "first_page", "num_words",
]


@query(
    "merge_runs",
    "WITH "
    + MERGED.replace("FROM filtered WINDOW", "FROM context WINDOW")
    + f" SELECT {', '.join(MERGED_COLUMNS)} FROM merged",
)
def merge_runs(t: Tables):
    # The merge reads its input twice.
    return cd.merge_runs(cut(ln.with_page_context(t.features))).select(*MERGED_COLUMNS)


@query("candidates", "WITH " + MERGED + f" SELECT {', '.join(MERGED_COLUMNS)} FROM merged")
def candidates(t: Tables):
    return cd.candidates(t.features).select(*MERGED_COLUMNS)


@query("sink_candidates", "WITH " + MERGED + f" SELECT {', '.join(MERGED_COLUMNS)} FROM merged")
def sink_candidates(t: Tables):
    folder = scratch(t.spark, "candidates")
    sinks.write_lines(cd.candidates(t.features), folder)
    return files.read_lines(t.spark, folder).select(*MERGED_COLUMNS)


RAW = ["doc_id", "line_idx", "page", "text", "font_size", "length", "num_words", "is_short", "line_top", "line_bottom"]


@query(
    "src_raw_lines",
    "WITH " + FEATURES + f""" SELECT doc_id::VARCHAR AS doc_id,
    (row_number() OVER (PARTITION BY doc_id ORDER BY line_idx) - 1)::INTEGER AS place, {', '.join(RAW[2:])} FROM features""",
)
def src_raw_lines(t: Tables):
    """Each document's lines as a JSON array in a file of its own, by the exact name that the reader of such files expects."""
    folder = scratch(t.spark, "lines")
    sinks.write_lines(t.features, folder, per_document=True)
    back = files.read_raw_lines(t.spark, folder)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("line_idx")) - 1
    return back.select("doc_id", place.cast("int").alias("place"), *RAW[2:])


@query("src_lines", "WITH " + FEATURES + f" SELECT {', '.join(RAW)} FROM features")
def src_lines(t: Tables):
    """Lines in the form of the line sink, many documents to a file."""
    folder = scratch(t.spark, "lines")
    sinks.write_lines(t.features, folder)
    return files.read_lines(t.spark, folder).select(*RAW)


# --- Labels ---------------------------------------------------------------------------------------


@query("src_labels", "WITH " + TRUTH + " SELECT doc_id::VARCHAR AS doc_id, pos, level, text, page FROM entries")
def src_labels(t: Tables):
    folder = scratch(t.spark, "labels")
    t.labels.select(F.col("doc_id").cast("string").alias("doc_id"), "title", "outline").write.json(folder)
    good, _ = files.read_label_lines(t.spark, folder)
    return files.outline_entries(good)


@query(
    "src_corrupt_skip",
    """SELECT doc_id::VARCHAR AS doc_id, CASE WHEN quality = 1 THEN 'read' ELSE 'skipped' END AS status
       FROM labels SEMI JOIN documents USING (doc_id)""",
)
def src_corrupt_skip(t: Tables):
    """Label documents of quality 0 are stored cut in half, and must be reported and skipped."""
    folder = scratch(t.spark, "labels")
    body = F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.lit("t").alias("title"), F.col("text").alias("rest")))
    rows = t.documents.select("doc_id", "text").join(t.read("labels").select("doc_id", "quality"), "doc_id", "inner")
    cut = F.when(F.col("quality") == 1, body).otherwise(F.substring(body, F.lit(1), F.floor(F.char_length(body) / 2).cast("int")))
    rows.select(cut.alias("value")).write.text(folder)
    good, broken = files.read_label_lines(t.spark, folder)
    named = broken.select(F.regexp_extract("content", '"doc_id":"([^"]*)"', 1).alias("doc_id"), F.lit("skipped").alias("status"))
    return good.select("doc_id", F.lit("read").alias("status")).unionByName(named)


@query("label_vocab", "WITH " + TRUTH + " SELECT doc_id, pos, level, text, page FROM entries WHERE level IN ('BODY', 'H1', 'H2', 'H3')")
def label_vocab(t: Tables):
    return lb.in_vocabulary(t.entries).select("doc_id", "pos", "level", "text", "page")


@query("docs_labelled", "WITH " + TRUTH + " SELECT doc_id, source FROM documents SEMI JOIN entries USING (doc_id)")
def docs_labelled(t: Tables):
    return lb.labelled(t.documents, t.labels, need_outline=True).select("doc_id", "source")


@query("docs_skipped", "WITH " + TRUTH + " SELECT doc_id, source FROM documents ANTI JOIN good USING (doc_id)")
def docs_skipped(t: Tables):
    return lb.unlabelled(t.documents, t.labels).select("doc_id", "source")


def _label_sql(rows: str, columns: str, choose: str, levels: str) -> str:
    return f"""
SELECT {columns}, coalesce(k.level, 'BODY') AS label
FROM {rows} r
LEFT JOIN (SELECT doc_id, page, {sql_strip('text')} AS text, {choose}(level, pos) AS level FROM entries
           WHERE level IN ({levels}) GROUP BY ALL) k
ON r.doc_id = k.doc_id AND r.page = k.page AND {sql_strip('r.text')} = k.text"""


KNOWN = "'H1', 'H2', 'H3'"


@query(
    "label_join_last",
    "WITH " + SPAN_FEATURES_SQL + "," + TRUTH
    + _label_sql("span_features", "r.doc_id, r.page, r.block_idx, r.line_idx, r.span_idx, r.text", "arg_max", KNOWN),
)
def label_join_last(t: Tables):
    spans = ln.with_span_features(t.spans).select("doc_id", "page", "block_idx", "line_idx", "span_idx", "text")
    return lb.label_last(spans, lb.in_vocabulary(t.entries))


@query(
    "label_join_first",
    "WITH " + FEATURES + "," + TRUTH
    + _label_sql("features", "r.doc_id, r.page, r.line_idx, r.text", "arg_min", KNOWN + ", 'H4'"),
)
def label_join_first(t: Tables):
    return lb.label_first(t.features.select("doc_id", "page", "line_idx", "text"), t.entries)


TITLE_LABEL = f"""
SELECT r.doc_id, r.page, r.line_idx, r.text,
       CASE WHEN len(list_filter(t.words, lambda w: contains(lower({sql_strip('r.text')}), w))) > 0 THEN 'Title'
            ELSE coalesce(k.level, 'NotHeading') END AS label
FROM features r
LEFT JOIN (SELECT doc_id, list_filter(string_split_regex(lower(title), '\\s+'), lambda w: w <> '') AS words FROM titles) t
       ON r.doc_id = t.doc_id
LEFT JOIN (SELECT doc_id, page, lower({sql_strip('text')}) AS text, arg_min(level, pos) AS level FROM entries GROUP BY ALL) k
       ON r.doc_id = k.doc_id AND r.page = k.page AND lower({sql_strip('r.text')}) = k.text"""


@query("label_join_title", "WITH " + FEATURES + "," + TRUTH + TITLE_LABEL)
def label_join_title(t: Tables):
    return lb.label_title(t.features.select("doc_id", "page", "line_idx", "text"), t.labels, t.entries)


@query(
    "level_render",
    "WITH "
    + LINES
    + """ SELECT doc_id, line_idx, CASE font_size WHEN 24 THEN 'H1' WHEN 16 THEN 'H2' WHEN 14 THEN 'H3' ELSE 'BODY' END
          AS level FROM lines""",
)
def level_render(t: Tables):
    size = F.col("font_size")
    number = F.when(size == 24, "0").when(size == 16, "1").when(size == 14, "2").otherwise("BODY")
    return t.lines.select("doc_id", "line_idx", lb.render_level(number).alias("level"))


# --- Titles and outlines --------------------------------------------------------------------------

ROW = ["doc_id", "page", "line_idx", "level", "text"]


@query("outline_rows", "WITH " + PREDICTED + " SELECT doc_id, page, line_idx, level, text FROM predicted WHERE level <> 'BODY'")
def outline_rows(t: Tables):
    return ol.outline_rows(t.predicted).select(*ROW)


@query(
    "title_span",
    "WITH "
    + SPAN_FEATURES_SQL
    + """ SELECT doc_id, coalesce(arg_min(text, (block_idx, line_idx, span_idx)) FILTER (WHERE page = 0 AND font_size >= 15 AND bold = 1),
          'Untitled') AS title FROM span_features GROUP BY doc_id""",
)
def title_span(t: Tables):
    return ol.span_titles(ln.with_span_features(t.spans))


OUTLINE = (
    PREDICTED
    + """,
outline AS (SELECT * FROM predicted WHERE level <> 'BODY'),
promoted AS (
  SELECT doc_id, arg_min(text, (page, line_top, line_idx)) AS title FROM outline
  WHERE level = 'H1' AND page = 0 GROUP BY doc_id
),
rest AS (
  SELECT o.* FROM outline o ANTI JOIN promoted p
  ON o.doc_id = p.doc_id AND o.level = 'H1' AND o.page = 0 AND o.text = p.title
)"""
)


@query(
    "title_promote",
    "WITH "
    + OUTLINE
    + """ SELECT doc_id, page, line_idx, level, text FROM rest
          UNION ALL SELECT doc_id, 0, -1, 'title', title FROM promoted""",
)
def title_promote(t: Tables):
    titles, rest = ol.promote_title(cut(ol.outline_rows(t.predicted)))
    head = titles.select(
        "doc_id", F.lit(0).alias("page"), F.lit(-1).alias("line_idx"), F.lit("title").alias("level"), F.col("title").alias("text")
    )
    return rest.select(*ROW).unionByName(head)


@query(
    "title_first_pred",
    "WITH "
    + MERGED
    + """,
labelled AS (
  SELECT *, CASE WHEN font_size >= 15 THEN 'Title' WHEN font_size >= 13 THEN 'H1' END AS level FROM merged
  WHERE font_size >= 13
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, level ORDER BY page, line_top, line_idx) AS n FROM labelled
)
SELECT doc_id, page, CASE WHEN level = 'Title' AND n = 1 THEN -1 ELSE line_idx END AS line_idx,
       CASE WHEN level = 'Title' AND n = 1 THEN 'first title' ELSE level END AS level, text
FROM (SELECT doc_id, CASE WHEN level = 'Title' AND n = 1 THEN 0 ELSE page END AS page, line_idx, level, text, n FROM ranked)""",
)
def title_first_pred(t: Tables):
    size = F.col("font_size")
    level = F.when(size >= 15, "Title").when(size >= 13, "H1").otherwise("NotHeading")
    rows = cut(ol.outline_rows(cd.candidates(t.features).withColumn("level", level), body="NotHeading"))
    titles, rest = ol.first_title_prediction(rows)
    head = titles.select(
        "doc_id", F.lit(0).alias("page"), F.lit(-1).alias("line_idx"), F.lit("first title").alias("level"), F.col("title").alias("text")
    )
    return rest.select(*ROW).unionByName(head)


def _flat(outlines):
    entry = F.transform("outline", lambda e: F.concat_ws("|", e["level"], e["page"].cast("string"), e["text"]))
    return outlines.select("doc_id", "part", "title", F.size("outline").alias("headings"), F.array_join(entry, "\n").alias("entries"))


def _outlines_sql(titles: str, rows: str, order: str, page_base: int = 0) -> str:
    """Outlines from relations of titles (doc_id, title) and heading rows."""
    return f""", parted AS (SELECT *, (page // {ol.PAGES_PER_PART})::INTEGER AS part FROM {rows})
          SELECT d.doc_id, d.part, coalesce(p.title, '') AS title, coalesce(r.headings, 0)::INTEGER AS headings,
                 coalesce(r.entries, '') AS entries
          FROM (SELECT doc_id, 0::INTEGER AS part FROM documents UNION SELECT doc_id, part FROM parted) d
          LEFT JOIN {titles} p ON d.doc_id = p.doc_id
          LEFT JOIN (SELECT doc_id, part, count(*) AS headings,
                            string_agg(level || '|' || (page + {page_base}) || '|' || text, chr(10) ORDER BY {order}) AS entries
                     FROM parted GROUP BY ALL) r ON d.doc_id = r.doc_id AND d.part = r.part"""


@query("outline_docs", "WITH " + OUTLINE + _outlines_sql("promoted", "rest", "page, line_top, line_idx"))
def outline_docs(t: Tables):
    return _flat(flow.outlines(t.documents, t.lines))


@query(
    "outline_spans",
    "WITH " + SPAN_FEATURES_SQL
    + """,
span_titles AS (
  SELECT doc_id, coalesce(arg_min(text, (block_idx, line_idx, span_idx)) FILTER (WHERE page = 0 AND font_size >= 15 AND bold = 1), 'Untitled')
         AS title FROM span_features GROUP BY doc_id
),
span_rows AS (
  SELECT *, CASE WHEN font_size >= 20 THEN 'H1' WHEN font_size >= 15 THEN 'H2' ELSE 'H3' END AS level
  FROM span_features WHERE font_size >= 13
)"""
    + _outlines_sql("span_titles", "span_rows", "page, block_idx, line_idx, span_idx", 1),
)
def outline_spans(t: Tables):
    return _flat(flow.span_outlines(t.documents, t.spans))


@query(
    "outline_text_layout",
    "WITH " + CONTEXT
    + """,
levelled AS (
  SELECT *, CASE WHEN font_size >= 20 THEN 'Title' WHEN font_size >= 15 THEN 'H1' WHEN length <= 60 THEN 'H4' END AS level FROM context
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, level ORDER BY page, line_top, line_idx) AS n FROM levelled WHERE level IS NOT NULL
),
first_titles AS (SELECT doc_id, text AS title FROM placed WHERE level = 'Title' AND n = 1),
others AS (SELECT * FROM placed WHERE NOT (level = 'Title' AND n = 1))"""
    + _outlines_sql("first_titles", "others", "page, line_top, line_idx"),
)
def outline_text_layout(t: Tables):
    """The flow of the text and layout model with a rule in its place."""
    size = F.col("font_size")
    rule = F.when(size >= 20, "Title").when(size >= 15, "H1").when(F.col("length") <= 60, "H4").otherwise("NotHeading")
    return _flat(flow.titled_outlines(t.documents, t.lines, rule))


@query("outline_model", "WITH " + OUTLINE + _outlines_sql("promoted", "rest", "page, line_top, line_idx"))
def outline_model(t: Tables):
    """The flow of a trained line model; a forest learns the size rule from the lines it is then applied to."""
    rows = cut(cd.candidates(t.features, words=True))
    train = rows.select("doc_id", "line_idx", *tr.LINE_FEATURES, lb.class_of(ol.level_by_size()).alias("class"))
    return _flat(flow.outlines(t.documents, t.lines, tr.fit(train, tr.LINE_FEATURES, tr.random_forest()), rows))


@query(
    "sink_outline",
    "WITH "
    + OUTLINE
    + """ SELECT d.doc_id, coalesce(p.title, '') AS title, r.level, r.text, r.page
          FROM documents d LEFT JOIN promoted p ON d.doc_id = p.doc_id LEFT JOIN rest r ON d.doc_id = r.doc_id""",
)
def sink_outline(t: Tables):
    folder = scratch(t.spark, "outlines")
    sinks.write_outlines(flow.outlines(t.documents, t.lines), folder)
    back = files.read_outlines(t.spark, folder)
    return back.select("doc_id", "title", F.explode_outer("outline").alias("e")).select(
        "doc_id", "title", "e.level", "e.text", "e.page"
    )
