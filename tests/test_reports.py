from __future__ import annotations

import json

from foliolens.operators import report as rp
from foliolens.sources import sinks


def parts(rows):
    configs = rows("collection string, persona string, job string", [("a", "P", "J"), ("b", None, "K")])
    documents = rows("collection string, doc_id long, document string", [("a", 2, "two"), ("a", 1, "one"), ("b", 3, "three")])
    sections = rows(
        "collection string, doc_id long, title string, importance_rank int, page int, refined_text string",
        [("a", 1, "s2", 2, 4, None), ("a", 1, "s1", 1, 3, "r1"), ("a", 2, "t1", 1, 1, "r2")],
    )
    return configs, documents, sections


def test_report_shape(rows):
    made = {(r.collection, r.part): json.loads(r.json) for r in rp.report_json(rp.assemble(*parts(rows))).collect()}
    assert set(made) == {("a", 0), ("b", 0)}
    a = made[("a", 0)]
    assert a["metadata"]["input_documents"] == ["one", "two"]
    assert (a["metadata"]["persona"], made[("b", 0)]["metadata"]["persona"]) == ("P", "")
    assert [(s["document"], s["section_title"], s["importance_rank"], s["page_number"]) for s in a["extracted_sections"]] == [
        ("one", "s1", 1, 3), ("one", "s2", 2, 4), ("two", "t1", 1, 1),
    ]
    assert [s["refined_text"] for s in a["subsection_analysis"]] == ["r1", "r2"]
    assert made[("b", 0)]["extracted_sections"] == []


def test_large_collections_go_on_in_parts(rows):
    made = rp.assemble(*parts(rows), per_part=1).collect()
    assert sorted((r.collection, r.part) for r in made) == [("a", 1), ("a", 2), ("b", 3)]
    held = {tuple(r.metadata.input_documents): len(r.extracted_sections) for r in made}
    assert held == {("one",): 2, ("two",): 1, ("three",): 0}


def test_validation_counts_violations(rows):
    good = {
        "metadata": {"input_documents": ["d"], "persona": "P", "job_to_be_done": "J", "processing_timestamp": "now"},
        "extracted_sections": [{"document": "d", "section_title": "t", "importance_rank": 1, "page_number": 1}],
        "subsection_analysis": [{"document": "d", "refined_text": "r", "page_number": 1}],
    }
    bad = {"metadata": {"persona": "Q"}, "extracted_sections": [{"document": "d"}, {"section_title": "t"}]}
    texts = rows("collection string, part int, json string", [("g", 0, json.dumps(good)), ("b", 0, json.dumps(bad))])
    truth = rows("collection string, part int, persona string, job string, documents long", [("g", 0, "P", "J", 1), ("b", 0, "P", "J", 1)])
    found = {r.rule: r.violations for r in rp.validate(rp.parse_reports(texts), truth).collect()}
    assert {r: n for r, n in found.items() if n} == {
        "analysis present": 1, "metadata.input_documents present": 1, "metadata.job_to_be_done present": 1,
        "metadata.processing_timestamp present": 1, "sections.document present": 1, "sections.section_title present": 1,
        "sections.importance_rank present": 2, "sections.page_number present": 2, "analysis not empty": 1,
        "persona equal": 1, "job equal": 1, "document count equal": 1,
    }
    assert set(rp.validate(rp.parse_reports(texts.limit(0)), truth).select("violations").distinct().collect()) == {(0,)}


def test_report_sink(spark, rows, tmp_path):
    sinks.write_reports(rp.report_json(rp.assemble(*parts(rows))), str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).where("collection = 'a'").count() == 1
