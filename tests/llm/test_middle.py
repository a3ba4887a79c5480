from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foliolens.llm.middle import MARKS, Bits, BoundarySet, Runs, Sorted, fill_in_middle, restore
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
P, S, M = MARKS


def plain(doc_id, text):
    """What the contract says, unit by unit."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, m, y = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(x), len(m), f"{S}{y}{P}{x}{M}{m}"
    return doc_id, n, "psm", len(x), len(m), f"{P}{x}{S}{y}{M}{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    ("values", "kinds"),
    [
        (np.arange(0, 60_000, 30), [Sorted]),
        (np.arange(100, 60_000), [Runs]),
        (np.arange(0, 65_536, 3), [Bits]),
        (np.concatenate([np.arange(0, 65_536, 2), np.arange(65_536, 131_072), [400_000, 400_007]]), [Bits, Runs, Sorted]),
        (np.array([0]), [Sorted]),
        (np.array([65_535, 65_536]), [Sorted, Sorted]),
    ],
)
def test_containers_select_every_rank(values, kinds):
    found = BoundarySet(values.astype(np.int64))
    assert [type(c) for c in found.containers] == kinds and len(found) == len(values)
    assert [found.select(i) for i in range(len(values))] == values.tolist()
    for rank in (-1, len(values)):
        with pytest.raises(IndexError):
            found.select(rank)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 300_000), max_size=500), st.integers(0, 200_000), st.integers(0, 9000), st.integers(1, 3))
def test_select_on_mixed_sets(some, first, length, step):
    values = np.array(sorted(some | set(range(first, first + length * step, step))), np.int64)
    found = BoundarySet(values)
    assert [found.select(i) for i in range(len(values))] == values.tolist()


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, FOLDER).collect()}
    assert got == {(*plain(d, t)[:-1], sha(plain(d, t)[-1]), sha(t or "")) for d, t in docs}


def test_odd_rows(rows):
    texts = [
        None, "", " ", "a", " a", "a ", "é ü\t x y \n", "x <P> y", "<S", "a<S b<P c<M d", "\x1c\x85 z", "word " * 300_000, "é" * 70_000 + " end", "𝒳 𝒴 𝒵 ",
    ]
    made = [(i * 1000 + k, t) for k, t in enumerate(texts) for i in range(40)] + [(None, "a b c"), (7, "r s"), (7, "r s"), (-5, "a b c d")]
    table = rows("doc_id long, text string, n string, form int, output int", [(*m, "clash", 0, 0) for m in made])
    out = fill_in_middle(table)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("back", restore("output", "form")).collect()
    assert sorted(map(str, (tuple(r)[:-1] for r in got))) == sorted(str(plain(*m)) for m in made)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in made)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(table.limit(0)).collect() == []


def test_other_marks_and_rates(rows):
    table = rows("doc_id long, text string", [(i, f"w{i} (x) [y] <P> z ") for i in range(200)])
    out = fill_in_middle(table, rate=100, suffix_first=0, seed=1, marks=("[p]", "(s)", "|m|"))
    got = out.withColumn("back", restore("output", "form", ("[p]", "(s)", "|m|"))).collect()
    assert {r.form for r in got} == {"psm"} and sorted(r.back for r in got) == sorted(t for _, t in table.collect())
