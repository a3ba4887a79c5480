"""Where the work of queries over many documents or files is done."""

from __future__ import annotations

import glob
import re

import pytest

from foliolens.catalog import learning, reports
from foliolens.catalog.base import Tables
from foliolens.plans import lineage


@pytest.fixture
def tables(spark, rows, tmp_path):
    texts = [(i, f"Title {i}\nshort line\n{'a long line of words, and more words ' * 4}\nNext one", "en", f"src{i % 7}", 9) for i in range(700)]
    rows("doc_id long, text string, lang string, source string, n_chars long", texts).write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, int(i % 3 == 0), 0) for i in range(0, 700, 2)]
    rows("doc_id long, quality int, toxic int", marks).write.parquet(str(tmp_path / "labels.parquet"))
    turns = [(i, 0, "user", f"job {i}") for i in range(7)]
    rows("conv_id long, turn long, role string, text string", turns).write.parquet(str(tmp_path / "conversations.parquet"))
    return Tables(spark, str(tmp_path))


@pytest.mark.parametrize("examples", [learning.span_examples, learning.line_examples])
def test_only_documents_with_labels_are_read_for_training(tables, examples, capsys):
    frame = examples(tables)
    assert {r.doc_id for r in frame.select("doc_id").distinct().collect()} == set(range(0, 700, 6))
    frame.explain(True)
    text = re.search(r"== Optimized Logical Plan ==\n(.*?)\n== Physical", capsys.readouterr().out, re.S)[1]
    plan = [line for line in text.splitlines() if re.match(r"[\s:]*[+:]- ", line)]  # without the rest of lines that hold line feeds
    depth = lambda line: len(re.match(r"[\s:+|-]*", line)[0])
    at = next(i for i, line in enumerate(plan) if "Generate posexplode(filter(split(" in line)
    below = [line for line in plan[at + 1 :]]
    end = next((i for i, line in enumerate(below) if depth(line) <= depth(plan[at])), len(below))
    assert any("Join LeftSemi" in line for line in below[:end])


def test_many_small_files_are_written_by_many_tasks(tables):
    found = {(r.collection, r.documents) for r in reports.src_collection(tables).collect()}
    assert found == {(f"src{s}-{p}", sum(i % 7 == s for i in range(100 * p, 100 * p + 100))) for s in range(7) for p in range(7)}
    folder = next(p for p in reversed(lineage._written) if "/collections-" in p).removeprefix("file:")
    names = glob.glob(f"{folder}/folder=*/part-*")
    assert len(names) == 49 and len({re.search(r"part-(\d+)", n)[1] for n in names}) >= 4
