from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from foliolens.plans.session import build

    session = build(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a table from a schema text and tuples."""

    def make(schema, data):
        return spark.createDataFrame(data, schema)

    return make
