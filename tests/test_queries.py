"""Every query with a SQL counterpart gives the same rows, types and values as DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from foliolens import catalog
from tests.conftest import FOLDER
from tools.compare import compare, connect

SQL = catalog.SQL
# Hundreds of rounds of boosting: compared by tools/compare.py, not here.
SLOW = {"train_gbt", "train_xgb_span"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, FOLDER), con, SQL[name]) == ""


# Decoding and training that SQL cannot express: held against plain versions in the tests of their operators.
WITHOUT_SQL = {"pos_tagged", "encode_sections", "topk_encoded"}


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(SQL) | WITHOUT_SQL
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert "text" in frame.columns
