"""The plans are the ones that are wanted at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from foliolens.catalog.base import Tables
from foliolens.operators import lines as ln
from foliolens.operators import relevance as rv
from tests.conftest import FOLDER


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_postings_are_not_shuffled(spark, no_broadcast):
    plan = plan_of(rv.section_scores(Tables(spark, FOLDER).sections))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert sum("REPARTITION_BY_COL" in line for line in plan.splitlines()) == 1
    assert not any("term" in keys or "section_idx" in keys for keys in exchanges)


def test_lines_are_shuffled_once_by_chunk(spark, no_broadcast):
    plan = plan_of(ln.with_page_context(Tables(spark, FOLDER).features))
    by_chunk = [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE", plan) if "_chunk" in k]
    # Once for the lines, and for their summaries once by page and once by chunk.
    assert len(by_chunk) == 2
    assert not any(re.fullmatch(r"doc_id#\d+L, \d+", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\), ENSURE", plan))


def test_top_sections_are_limited_before_the_shuffle(spark):
    assert plan_of(entry.queries()["topk_sections"](spark, FOLDER)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name", ["candidates", "outline_docs", "label_join_title", "topk_sections", "refine_text", "page_blocks", "pos_counts", "split_strat"]
)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert not re.search("EvalPython|InPandas|CartesianProduct|NestedLoop|PythonUDF", plan)


@pytest.mark.parametrize(
    "name, columns", [("docs_skipped", "doc_id:bigint,source:string"), ("label_vocab", "doc_id:bigint,text:string"), ("cache_new_docs", "doc_id:bigint")]
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    read = re.findall(r"documents\.parquet\].*?ReadSchema: struct<([^>]*)>", plan)
    assert read and all(set(scan.split(",")) <= set(columns.split(",")) for scan in read)
