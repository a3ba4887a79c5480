from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from foliolens.operators import labels as lb
from foliolens.operators import outline as ol
from foliolens.operators import training as tr
from foliolens.sources import files, sinks

ENTRY = "doc_id long, pos int, level string, text string, page int"
LINE = "doc_id long, page int, line_idx int, text string"


@pytest.fixture
def entries(rows):
    return rows(ENTRY, [(1, 0, "H1", "Intro ", 0), (1, 1, "H3", "Intro", 0), (1, 2, "H4", "Deep", 1), (2, 0, "H2", "Intro", 0)])


@pytest.fixture
def lines(rows):
    return rows(LINE, [(1, 0, 0, " Intro"), (1, 1, 1, "Intro"), (1, 1, 2, "Deep"), (1, 1, 3, "intro"), (3, 0, 0, "Intro")])


def labels_of(frame):
    return {(r.doc_id, r.line_idx): r.label for r in frame.collect()}


def test_duplicate_labels(lines, entries):
    assert labels_of(lb.label_first(lines, entries)) == {
        (1, 0): "H1", (1, 1): "BODY", (1, 2): "H4", (1, 3): "BODY", (3, 0): "BODY",
    }
    assert labels_of(lb.label_last(lines, entries))[(1, 0)] == "H3"
    assert labels_of(lb.label_last(lines, lb.in_vocabulary(entries)))[(1, 2)] == "BODY"


def test_one_based_label_pages(lines, rows):
    entries = rows(ENTRY, [(1, 0, "H2", "Intro", 2)])
    assert labels_of(lb.label_last(lines, entries, page_base=1))[(1, 1)] == "H2"


def test_title_words_come_first(lines, entries, rows):
    titles = rows("doc_id long, title string", [(1, "  Tro  x"), (2, ""), (3, None)])
    assert labels_of(lb.label_title(lines, titles, entries)) == {
        (1, 0): "Title", (1, 1): "Title", (1, 2): "H4", (1, 3): "Title", (3, 0): "NotHeading",
    }
    empty = rows("doc_id long, title string", [(1, " ")])
    assert labels_of(lb.label_title(lines, empty, entries))[(1, 0)] == "H1"


def test_levels(spark):
    frame = spark.createDataFrame([("0",), ("2",), ("BODY",), ("H3",)], "v string")
    assert [r[0] for r in frame.select(lb.render_level("v")).collect()] == ["H1", "H3", "BODY", "H3"]
    numbers = spark.createDataFrame([(0,), (1,), (3,)], "n int")
    assert [r[0] for r in numbers.select(lb.level_of("n")).collect()] == ["BODY", "H1", "H3"]


def test_label_files(spark, tmp_path):
    (tmp_path / "A b.json").write_text(json.dumps({"title": "T", "outline": [{"level": "H1", "text": "X", "page": 0}]}, indent=1))
    (tmp_path / "none.json").write_text('{"title": "only"}')
    (tmp_path / "bad.json").write_text('{"title": "x", "outl')
    (tmp_path / "A b_raw.json").write_text("[]")
    good, broken = files.read_label_files(spark, str(tmp_path))
    assert {(r.doc_id, r.title, len(r.outline)) for r in good.collect()} == {("A b", "T", 1), ("none", "only", 0)}
    assert [(r.doc_id, r.content) for r in broken.collect()] == [("bad", '{"title": "x", "outl')]
    assert broken.count() == 1 and good.count() == 2
    assert [tuple(r) for r in files.outline_entries(good).collect()] == [("A b", 0, "H1", "X", 0)]


def test_raw_line_files_keep_file_order(spark, tmp_path):
    records = [{"text": t, "font_size": 9.5, "page": p, "bold": 0} for t, p in [("b", 0), ("é", 0), ("a", 1)]]
    (tmp_path / "doc_raw.json").write_text(json.dumps(records, ensure_ascii=False, indent=2), encoding="utf-8")
    (tmp_path / "doc.json").write_text('{"title": "x"}')
    lines = files.read_raw_lines(spark, str(tmp_path)).orderBy("line_idx")
    assert [(r.doc_id, r.text, r.page) for r in lines.collect()] == [("doc", "b", 0), ("doc", "é", 0), ("doc", "a", 1)]
    filled = tr.filled(lines, tr.LINE_FEATURES).first()
    assert filled["num_words"] == 0.0 and filled["font_size"] == 9.5


def test_document_listing_and_collections(spark, tmp_path):
    for name in ["One two.pdf", "b.PDF", "c+d.Pdf", "no.txt"]:
        (tmp_path / name).write_bytes(b"%PDF")
    assert {r.doc_id for r in files.list_documents(spark, str(tmp_path)).collect()} == {"One two", "b", "c+d"}
    assert {r.doc_id for r in files.list_documents(spark, str(tmp_path), any_case=False).collect()} == {"One two"}
    inner = tmp_path / "Collection 1"
    inner.mkdir()
    (inner / "my_input.json").write_text(
        json.dumps({"documents": [{"filename": "a.pdf", "title": "A"}], "persona": {"role": "Planner"}}, indent=2)
    )
    assert [tuple(r) for r in files.read_collections(spark, str(tmp_path)).collect()] == [
        ("Collection 1", "Planner", "", ["a.pdf"])
    ]


ROW = "doc_id long, page int, line_idx int, line_top double, level string, text string"


def test_promotion_removes_equal_rows(rows):
    outline = rows(
        ROW,
        [
            (1, 0, 0, 5.0, "H2", "Sub"), (1, 0, 1, 9.0, "H1", "Name"), (1, 0, 2, 12.0, "H1", "Name"),
            (1, 1, 3, 1.0, "H1", "Name"), (2, 1, 0, 1.0, "H1", "Late"),
        ],
    )
    titles, rest = ol.promote_title(outline)
    assert [tuple(r) for r in titles.collect()] == [(1, "Name")]
    assert sorted((r.doc_id, r.line_idx) for r in rest.collect()) == [(1, 0), (1, 3), (2, 0)]
    documents = rows("doc_id long", [(1,), (2,), (3,)])
    made = {(r.doc_id, r.part): (r.title, [e.text for e in r.outline]) for r in ol.outline_documents(documents, titles, rest).collect()}
    assert made == {(1, 0): ("Name", ["Sub", "Name"]), (2, 0): ("", ["Late"]), (3, 0): ("", [])}
    parts = ol.outline_documents(documents, titles, rest, per_part=1).where("doc_id = 1").orderBy("part").collect()
    assert [(r.part, [e.text for e in r.outline]) for r in parts] == [(0, ["Sub"]), (1, ["Name"])]


def test_first_title_prediction(rows):
    outline = rows(ROW, [(1, 1, 4, 1.0, "Title", "Second"), (1, 0, 1, 1.0, "Title", "First"), (1, 0, 0, 0.0, "H1", "Head")])
    titles, rest = ol.first_title_prediction(outline)
    assert [tuple(r) for r in titles.collect()] == [(1, "First")]
    assert {r.text for r in rest.collect()} == {"Second", "Head"}


def test_span_title(rows):
    spans = rows(
        "doc_id long, page int, block_idx int, line_idx int, span_idx int, text string, font_size double, bold int",
        [
            (1, 0, 0, 0, 0, "small", 14.9, 1), (1, 0, 0, 1, 0, "Big", 15.0, 1), (1, 0, 1, 0, 0, "Later", 30.0, 1),
            (2, 1, 0, 0, 0, "P2", 20.0, 1),
        ],
    )
    assert {tuple(r) for r in ol.span_titles(spans).collect()} == {(1, "Big"), (2, "Untitled")}


def test_sinks(spark, rows, tmp_path):
    outline = rows("doc_id long, part int, title string, outline array<struct<level string, text string, page int>>",
                   [(1, 0, "é", [("H1", "x", 0)]), (2, 0, "", [])])
    sinks.write_outlines(outline, str(tmp_path / "many"))
    back = files.read_outlines(spark, str(tmp_path / "many")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.title, len(r.outline)) for r in back] == [(1, "é", 1), (2, "", 0)]
    sinks.write_outlines(outline, str(tmp_path / "each"), per_document=True)
    made = {f.name: json.loads(f.read_text()) for f in (tmp_path / "each").iterdir()}
    assert made == {"1.json": {"title": "é", "outline": [{"level": "H1", "text": "x", "page": 0}]}, "2.json": {"title": "", "outline": []}}


def test_label_joins_repeat_nothing_and_split_hot_keys(spark):
    """The label side is joined once; the rows of a line that is repeated on one page are split over tasks."""
    hot = spark.range(60_000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("page"), F.col("id").alias("line_idx"), F.lit("Again").alias("text"),
        F.sha2(F.col("id").cast("string"), 512).alias("more"),
    )
    others = spark.range(3000).select(
        (F.col("id") + 2).alias("doc_id"), F.lit(0).alias("page"), F.lit(0).cast("long").alias("line_idx"), F.concat(F.lit("t"), F.col("id")).alias("text"),
        F.lit("").alias("more"),
    )
    lines = hot.unionByName(others).repartition(16)
    entries = lines.where("line_idx = 0").select("doc_id", F.lit(0).alias("pos"), F.lit("H1").alias("level"), "text", "page")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lb.label_last(lines, entries)
        counts = {r.label: r["count"] for r in joined.groupBy("label").count().collect()}
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert counts == {"H1": 63_000}
    assert "SortMergeJoin(skew=true)" in plan and "Generate" not in plan
