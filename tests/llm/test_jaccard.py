from __future__ import annotations

import random
import re

import numpy as np
import pytest

from foliolens.llm import jaccard
from foliolens.llm.components import components
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((root(parent, a), root(parent, b)))
                parent[q] = p
    return sorted((d, len(s), root(parent, d)) for d, s in sets)


def got(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


@pytest.mark.parametrize("seed", range(4))
def test_similar_sets_share_a_signature_that_is_indexed_and_probed(seed):
    draw = np.random.default_rng(seed)
    for _ in range(300):
        n = int(draw.integers(1, [8, 30, 150, 900][seed]))
        x = draw.integers(0, 2**63, n).astype(np.uint64)
        lost = draw.integers(0, n // 4 + 1)
        new = draw.integers(0, n // 4 + 1)
        y = np.unique(np.append(x[lost:], draw.integers(0, 2**63, new).astype(np.uint64)))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if not len(y) or 100 * both < 80 * (len(x) + len(y) - both) or set(x) == set(y):
            continue
        key, owner, role = jaccard.signatures([x, y])
        small = int(len(y) < len(x))
        indexed = set(key[(owner == small) & (role % 2 == 1)])
        probed = set(key[(owner != small) & (role >= 2)])
        assert indexed & probed, (len(x), len(y), both)


def test_equal_sizes_and_signatures_do_not_depend_on_the_company():
    draw = np.random.default_rng(9)
    sets = [np.unique(draw.integers(0, 2**63, int(n)).astype(np.uint64)) for n in (3, 40, 41, 7, 600)]
    key, owner, role = jaccard.signatures(sets)
    for i, s in enumerate(sets):
        alone = jaccard.signatures([s])
        assert sorted(zip(key[owner == i], role[owner == i])) == sorted(zip(alone[0], alone[2]))


def test_components(rows):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (9, 9), (50, 60), (60, 50), (60, 51)]
    random.Random(1).shuffle(chain)
    found = {r.node: r.component for r in components(rows("a long, b long", chain)).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3, 9: 3, 50: 50, 51: 50, 60: 50}
    assert components(rows("a long, b long", [])).collect() == []


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [draw.choices(vocabulary, k=draw.choice([1, 3, 4, 5, 6, 8, 12, 20, 60, 200])) for _ in range(n // 4)]
    out = []
    for d in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
            text[draw.randrange(len(text))] = draw.choice(vocabulary)
        if draw.random() < 0.3:
            text = text[: draw.randint(1, len(text))]
        out.append((d * 3 + 1, " ".join(text).upper() if draw.random() < 0.2 else "\n".join(text)))
    return out


def test_against_brute_force(rows):
    docs = corpus(2, 400) + [(2, None), (5, ""), (8, " \n\t"), (11, "one"), (14, "ONE"), (17, "one two"), (20, "a b c d e")]
    frame = rows("doc_id long, text string, n int, target int", [(*d, 0, 0) for d in docs])
    assert got(jaccard.jaccard_components(frame)) == brute(docs)


def test_crowded_group_of_near_copies_and_a_common_passage(rows):
    draw = random.Random(3)
    text = [f"t{i}" for i in range(80)]
    docs = []
    for d in range(150):
        copy = list(text)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(80)] = f"x{draw.randrange(1000)}"
        docs.append((d, " ".join(copy)))
    docs += [(d, " ".join(text[:40] + [f"y{d}-{i}" for i in range(30)])) for d in range(150, 200)]
    assert got(jaccard.jaccard_components(rows("doc_id long, text string", docs))) == brute(docs)


def test_nearest_and_all_pairs_across_components():
    """Bitmaps are compared as bits, whatever the sign of their longs."""
    import pyarrow as pa

    draw = np.random.default_rng(5)
    base = np.unique(draw.integers(0, 2**63, 60).astype(np.uint64))
    sets = []
    for _ in range(40):
        new = draw.integers(0, 2**63, int(draw.integers(0, 12))).astype(np.uint64)
        sets.append(np.unique(np.append(draw.permutation(base)[: 60 - len(new) // 2], new)))
    place = draw.integers(0, 5, 40)
    table = pa.table({
        "doc": np.arange(40), "role": np.full(40, 3, np.int32), "component": place, "n": [len(s) for s in sets],
        "bits": pa.array([jaccard.parity(s) for s in sets], pa.list_(pa.int64())),
    })

    def similar(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if place[i] != place[j] and similar(i, j)}
    every, near = (set(zip(*(jaccard._near(e)(table).column(c).to_pylist() for c in "ab"))) for e in (True, False))
    assert want <= every and len(want) > 50
    assert near <= every and len(near) <= 40
    assert {i for p in near for i in p} == {i for p in every for i in p}


def test_odd_tables(rows):
    assert jaccard.jaccard_components(rows("doc_id long, text string", [])).collect() == []
    assert got(jaccard.jaccard_components(rows("doc_id long, text string", [(4, None)]))) == [(4, 0, 4)]
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, "z " * 30_000)]
    assert got(jaccard.jaccard_components(rows("doc_id long, text string", docs))) == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 3)]
    kept = jaccard.one_of_each(rows("doc_id long, text string, n int", [(*d, 5) for d in docs[1:]]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and kept.columns == ["doc_id", "text", "n"]


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op7_ngram_jaccard"](spark, FOLDER)) == brute(docs)
