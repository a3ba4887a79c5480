"""Training sets, scaling, splits, trained models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliolens.catalog.base import CONTEXT, FEATURES, LINES, TRUTH, Tables, query
from foliolens.catalog.headings import KNOWN, TITLE_LABEL, _label_sql
from foliolens.catalog.layout import POS, SPAN_FEATURES_SQL
from foliolens.operators import labels as lb
from foliolens.operators import lines as ln
from foliolens.operators import outline as ol
from foliolens.operators import training as tr
from foliolens.plans.lineage import cut, scratch
from foliolens.sources import tables as tb

CLASS = "CASE label WHEN 'BODY' THEN 0 WHEN 'H1' THEN 1 WHEN 'H2' THEN 2 WHEN 'H3' THEN 3 END::INTEGER AS class"


def span_examples(t: Tables):
    """Features look no further than the document, so only documents with labels are read for them."""
    spans = tb.text_spans(lb.labelled(t.documents, t.labels, need_outline=True))
    return tr.span_training_set(ln.with_span_features(spans), t.labels)


def line_examples(t: Tables):
    lines = tb.text_lines(lb.labelled(t.documents, t.labels))
    return tr.line_training_set(ln.with_page_context(ln.with_line_features(lines)), t.labels)


def text_examples(t: Tables):
    lines = tb.text_lines(lb.labelled(t.documents, t.labels))
    return tr.text_training_set(ln.with_page_context(ln.with_line_features(lines, words=False)), t.labels)


def labelled_lines(t: Tables):
    """The same lines without word classes and page context, for what needs their labels only."""
    return tr.line_training_set(t.features, t.labels)


@query(
    "train_set_span",
    "WITH " + SPAN_FEATURES_SQL + "," + TRUTH
    + f", labelled AS ({_label_sql('(SELECT * FROM span_features SEMI JOIN entries USING (doc_id))', 'r.*', 'arg_max', KNOWN)})"
    + f" SELECT doc_id, block_idx, line_idx, span_idx, font_size, bold, top, spacing, label, {CLASS} FROM labelled",
)
def train_set_span(t: Tables):
    return span_examples(t).select("doc_id", "block_idx", "line_idx", "span_idx", *tr.SPAN_FEATURES, "label", "class")


LINE_EXAMPLES = (
    POS + "," + TRUTH
    + f", labelled AS ({_label_sql('(SELECT * FROM pos SEMI JOIN good USING (doc_id))', 'r.*', 'arg_min', KNOWN + ', ' + chr(39) + 'H4' + chr(39))})"
)


@query(
    "train_set_line",
    "WITH " + LINE_EXAMPLES
    + f" SELECT doc_id, line_idx, {', '.join(tr.LINE_FEATURES)}, label, {CLASS} FROM labelled WHERE label <> 'H4'",
)
def train_set_line(t: Tables):
    return line_examples(t).select("doc_id", "line_idx", *tr.LINE_FEATURES, "label", "class")


@query(
    "train_set_text",
    "WITH " + CONTEXT + "," + TRUTH + ", titled AS ("
    + TITLE_LABEL.replace("FROM features r", "FROM (SELECT * FROM context SEMI JOIN good USING (doc_id)) r").replace(
        "SELECT r.doc_id, r.page, r.line_idx, r.text,", "SELECT r.*,"
    )
    + f""") SELECT doc_id, line_idx, text, {', '.join(tr.LAYOUT_FEATURES)}, label,
       CASE label WHEN 'Title' THEN 0 WHEN 'H1' THEN 1 WHEN 'H2' THEN 2 WHEN 'H3' THEN 3 WHEN 'H4' THEN 4 ELSE 5 END::INTEGER AS class
       FROM titled""",
)
def train_set_text(t: Tables):
    rows = tr.text_training_set(ln.with_page_context(t.features), t.labels)
    return rows.select("doc_id", "line_idx", "text", *tr.LAYOUT_FEATURES, "label", "class")


SIMPLE_EXAMPLES = (
    CONTEXT + "," + TRUTH
    + f", labelled AS ({_label_sql('(SELECT * FROM context SEMI JOIN good USING (doc_id))', 'r.*', 'arg_min', KNOWN + ', ' + chr(39) + 'H4' + chr(39))})"
)


@query(
    "train_counts",
    "WITH " + SIMPLE_EXAMPLES
    + """ SELECT 'samples' AS counter, count(*) AS n FROM labelled WHERE label <> 'H4'
          UNION ALL SELECT 'headings', count(*) FROM labelled WHERE label NOT IN ('H4', 'BODY')
          UNION ALL SELECT 'skipped documents', count(*) FROM documents ANTI JOIN good USING (doc_id)""",
)
def train_counts(t: Tables):
    return tr.training_counts(labelled_lines(t), t.documents, t.labels)


@query(
    "class_report",
    "WITH " + SIMPLE_EXAMPLES
    + """,
pairs AS (
  SELECT label, CASE WHEN font_size >= 20 THEN 'H1' WHEN font_size >= 15 THEN 'H2' WHEN font_size >= 13 THEN 'H3' ELSE 'BODY' END
         AS predicted FROM labelled WHERE label <> 'H4'
),
classes AS (SELECT unnest(['BODY', 'H1', 'H2', 'H3', 'H4']) AS class),
counts AS (
  SELECT class, count_if(label = class AND predicted = class) AS hits, count_if(predicted = class) AS found,
         count_if(label = class) AS support
  FROM classes, pairs GROUP BY class
),
ratios AS (
  SELECT *, coalesce(hits / nullif(found, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall FROM counts
),
scored AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM ratios)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM (
  SELECT class, precision, recall, f1, support FROM scored
  UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM scored
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scored
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM scored)""",
)
def class_report(t: Tables):
    predicted = labelled_lines(t).select("label", ol.level_by_size().alias("predicted"))
    rows = tr.classification_report(predicted, "label", "predicted", [*lb.LEVELS, "H4"])
    return rows.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "scale_features",
    "WITH " + POS + " SELECT doc_id, line_idx, "
    + ", ".join(
        f"round(({n} - avg({n}) OVER ()) / coalesce(nullif(stddev_pop({n}) OVER (), 0), 1), 4) AS {n}" for n in tr.LINE_FEATURES
    )
    + " FROM pos",
)
def scale_features(t: Tables):
    rows = cut(ln.with_page_context(t.all_features).select("doc_id", "line_idx", *tr.LINE_FEATURES))
    scaled = tr.Scaling(rows, tr.LINE_FEATURES).transform(rows)
    return scaled.select("doc_id", "line_idx", *[F.round(n, 4).alias(n) for n in tr.LINE_FEATURES])


HASH = "('0x' || substr(md5('42-' || doc_id || '-' || line_idx), 1, 8))::BIGINT"


@query("split_hash", "WITH " + LINES + f" SELECT doc_id, line_idx, CASE WHEN {HASH} % 1000 < 800 THEN 'train' ELSE 'test' END AS part FROM lines")
def split_hash(t: Tables):
    return tr.split(t.lines.select("doc_id", "line_idx"), ["doc_id", "line_idx"])


@query(
    "split_strat",
    "WITH " + SIMPLE_EXAMPLES
    + f""" SELECT doc_id, line_idx, label,
           CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {HASH}, doc_id, line_idx) - 1
                     < floor(count(*) OVER (PARTITION BY label) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part
           FROM labelled WHERE label <> 'H4'""",
)
def split_strat(t: Tables):
    rows = labelled_lines(t).select("doc_id", "line_idx", "label")
    return tr.split_stratified(rows, ["doc_id", "line_idx"])


# --- Trained models: the held-out rows of each class, and whether the model reaches a stated accuracy on them ----------

#: Share of the errors of always guessing the most frequent held-out class that each model must avoid.
LIFT = 0.1
GBT_ROUNDS = 100
SPAN_KEYS = ["doc_id", "block_idx", "line_idx", "span_idx"]


def report_of(model, test, names, vocabulary=lb.LEVELS):
    """Precision, recall, F1 and support of every class of the held-out rows, written out."""
    scored = tr.score(test, model, names, vocabulary).withColumn("label", lb.level_of("class", vocabulary))
    return cut(tr.classification_report(scored, "label", "level", list(vocabulary)))


def better_than_guessing(report) -> bool:
    """Whether the accuracy lies above the share of the most frequent class by a tenth of what is left."""
    rows = {r["class"]: r for r in report.collect()}
    total = rows["accuracy"]["support"]
    most = max(r["support"] for c, r in rows.items() if c not in OVERALL) / total if total else 0.0
    return rows["accuracy"]["f1"] >= most + LIFT * (1 - most)


OVERALL = ["accuracy", "macro avg", "weighted avg"]


def _held_out(model, test, names, vocabulary=lb.LEVELS):
    report = report_of(model, test, names, vocabulary)
    classes = report.where(~F.col("class").isin(OVERALL))
    return classes.select("class", "support", F.lit(int(better_than_guessing(report))).alias("accurate"))


def _parts(rows, keys):
    marked = cut(tr.split(rows, keys))
    return marked.where("part = 'train'"), marked.where("part = 'test'")


def _support_sql(counts: str, vocabulary) -> str:
    """Held-out rows of every class of the vocabulary, from a relation of label and n."""
    classes = ", ".join(f"('{c}')" for c in vocabulary)
    return f""" SELECT class, coalesce(n, 0)::BIGINT AS support, 1 AS accurate FROM (VALUES {classes}) v(class)
          LEFT JOIN ({counts}) c ON c.label = v.class"""


SPAN_HASH = "('0x' || substr(md5('42-' || doc_id || '-' || block_idx || '-' || line_idx || '-' || span_idx), 1, 8))::BIGINT"
SPAN_SUPPORT = (
    "WITH " + SPAN_FEATURES_SQL + "," + TRUTH
    + f", labelled AS ({_label_sql('(SELECT * FROM span_features SEMI JOIN entries USING (doc_id))', 'r.*', 'arg_max', KNOWN)})"
    + _support_sql(f"SELECT label, count(*) AS n FROM labelled WHERE {SPAN_HASH} % 1000 >= 800 GROUP BY label", lb.LEVELS)
)


def _span_model(t: Tables, classifier, scale: bool = False):
    train, test = _parts(span_examples(t), SPAN_KEYS)
    return _held_out(tr.fit(train, tr.SPAN_FEATURES, classifier, scale=scale), test, tr.SPAN_FEATURES)


@query("train_rf", SPAN_SUPPORT)
def train_rf(t: Tables):
    return _span_model(t, tr.random_forest())


@query("train_xgb_span", SPAN_SUPPORT)
def train_xgb_span(t: Tables):
    return _span_model(t, tr.softmax_trees(rounds=GBT_ROUNDS, depth=5))


@query("train_mlp", SPAN_SUPPORT)
def train_mlp(t: Tables):
    return _span_model(t, tr.perceptron(len(tr.SPAN_FEATURES)), scale=True)


@query(
    "train_gbt",
    "WITH " + SIMPLE_EXAMPLES
    + _support_sql("SELECT label, count(*) - floor(count(*) * 0.8::DOUBLE) AS n FROM labelled GROUP BY label", lb.LEVELS),
)
def train_gbt(t: Tables):
    # Written out first, as the split reads its rows several times.
    rows = cut(line_examples(t).select("doc_id", "line_idx", *tr.LINE_FEATURES, "label", "class"))
    marked = cut(tr.split_stratified(rows, ["doc_id", "line_idx"]))
    train, test = marked.where("part = 'train'"), marked.where("part = 'test'")
    model = tr.fit(train, tr.LINE_FEATURES, tr.softmax_trees(rounds=GBT_ROUNDS), scale=True)
    return _held_out(model, test, tr.LINE_FEATURES)


@query(
    "train_text_layout",
    "WITH " + FEATURES + "," + TRUTH
    + ", labelled AS (SELECT * FROM (" + TITLE_LABEL + ") SEMI JOIN good USING (doc_id))"
    + _support_sql(f"SELECT label, count(*) AS n FROM labelled WHERE {HASH} % 1000 >= 800 GROUP BY label", lb.TEXT_LEVELS),
)
def train_text_layout(t: Tables):
    train, test = _parts(text_examples(t).select("doc_id", "line_idx", "text", *tr.LAYOUT_FEATURES, "class"), ["doc_id", "line_idx"])
    return _held_out(tr.fused_classifier(train), test, tr.LAYOUT_FEATURES, lb.TEXT_LEVELS)


def _line_model(t: Tables):
    """The full forest, trained on four fifths of the labelled lines, and the other fifth."""
    train, test = _parts(line_examples(t).select("doc_id", "line_idx", *tr.LINE_FEATURES, "class"), ["doc_id", "line_idx"])
    return tr.fit(train, tr.LINE_FEATURES, tr.random_forest(), scale=True), test


@query("score_lines", "WITH " + FEATURES + " SELECT doc_id, line_idx, 1 AS known, 1 AS accurate FROM features")
def score_lines(t: Tables):
    """Every line scored by a model trained on labelled lines: is the level a known one, and is the model right on enough held-out lines."""
    model, test = _line_model(t)
    accurate = F.lit(int(better_than_guessing(report_of(model, test, tr.LINE_FEATURES)))).alias("accurate")
    scored = tr.score(ln.with_page_context(t.all_features), model, tr.LINE_FEATURES)
    return scored.select("doc_id", "line_idx", F.col("level").isin(*lb.LEVELS).cast("int").alias("known"), accurate)


@query("model_roundtrip", "WITH " + POS + " SELECT count(*) AS rows, 0::BIGINT AS differing FROM pos")
def model_roundtrip(t: Tables):
    """Lines scored, and lines on which a saved and reloaded model disagrees with the model itself."""
    (model, _), folder = _line_model(t), scratch(t.spark, "model")
    tr.save(model, folder)
    rows = ln.with_page_context(t.all_features)
    once = tr.score(rows, model, tr.LINE_FEATURES).withColumnRenamed("level", "level_before")
    again = tr.score(once, tr.load(folder), tr.LINE_FEATURES)
    return again.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("level").eqNullSafe(F.col("level_before"))).alias("differing")
    )
