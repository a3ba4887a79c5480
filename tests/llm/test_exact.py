from __future__ import annotations

import hashlib

import numpy as np
import pytest

from foliolens.llm.exact import PerfectHash, exact_dedup, largest_of_each
from foliolens.llm.queries import QUERIES, SQL
from tests.conftest import FOLDER
from tools.compare import compare, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) == ""


def digests(values):
    return np.array([np.frombuffer(hashlib.sha256(str(v).encode()).digest(), np.uint8) for v in values]).reshape(-1, 32)


def test_perfect_hash_is_minimal_and_survives_a_round_trip():
    members = digests(range(5000))
    tree = PerfectHash.load(*PerfectHash.build(members).dump())
    assert sorted(tree.slots(members)) == list(range(5000))
    table = members[np.argsort(tree.slots(members))]
    others = digests(range(10**6, 10**6 + 3000))
    slots = tree.slots(others)
    assert not (table[slots[slots >= 0]] == others[slots >= 0]).all(axis=1).any()
    assert list(PerfectHash.build(members[:0]).slots(others[:2])) == [-1, -1]


def test_keys_equal_in_the_hashed_part_are_told_apart():
    members = digests(range(4))
    members[1, 8:24] = members[0, 8:24]
    assert sorted(PerfectHash.build(members).slots(members)) == [0, 1, 2, 3]


def test_rows(rows):
    schema = "doc_id long, text string, digest int, part string"
    old = rows(schema, [(1, "A b", 0, ""), (2, None, 0, ""), (3, "É", 0, ""), (None, "q", 0, "")])
    new = rows(schema, [(4, "a B", 0, ""), (5, "", 0, ""), (6, "é", 0, ""), (7, "new", 0, ""), (7, "NEW", 0, ""), (None, "q", 0, "")])
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup(old, new).collect())
    assert got == sorted([
        ("1", 4, 2, False), ("4", 4, 2, True), ("2", 5, 2, False), ("5", 5, 2, True), ("3", 3, 1, True), ("6", 6, 1, True),
        ("7", 7, 2, True), ("7", 7, 2, True), ("None", None, 2, True), ("None", None, 2, True),
    ])
    assert exact_dedup(old.limit(0), new.limit(0)).collect() == []
    assert exact_dedup(old.limit(0), new).count() == 6
    assert exact_dedup(old, new.limit(0)).count() == 4


def test_largest_of_each_decides_by_doc_id_and_text(rows):
    made = [(1, "a", 0), (1, "b", 1), (1, "b", 1), (2, "A", 2), (3, "c", 3), (3, "a", 4), (None, "C", 5), (None, "d", 6), (None, "d", 6), (4, None, 7)]
    out = largest_of_each(rows("doc_id long, text string, own int", made))
    assert out.columns == ["doc_id", "text", "own"]
    assert sorted(tuple(r) for r in out.collect() if r.doc_id) == [(1, "b", 1), (3, "a", 4), (3, "c", 3), (4, None, 7)]
    assert [tuple(r) for r in out.collect() if r.doc_id is None] == [(None, "d", 6)]
