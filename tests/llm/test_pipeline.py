from __future__ import annotations

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from foliolens.llm.queries import QUERIES
from tests.conftest import FOLDER
from tests.llm import test_jaccard, test_packing, test_seeds


def may_overlap(text, item):
    """Whether some alignment has as many equal words as a window needs: spares the slow comparison most pairs."""
    a, b = np.array(test_seeds.low(text)), np.array(test_seeds.low(item))
    if len(b) < test_seeds.SHORTEST or not len(a):
        return False
    i, j = np.nonzero(a[:, None] == b)
    n = min(test_seeds.WINDOW, len(b))
    return len(i) > 0 and np.bincount(i - j + len(b)).max() >= n - int(test_seeds.TOLERANCE * n + 1e-9)


def plain(docs, items):
    """(doc_id, text) that each stage keeps."""
    docs = [(d, t) for d, t in docs if t and any(c.isalpha() for c in t)]
    yield docs
    best = {}
    for d, t in docs:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        best[key] = max(d, best.get(key, d))
    docs = [(d, t) for d, t in docs if d in set(best.values())]
    yield docs
    root = {d: c for d, _, c in test_jaccard.brute(docs)}
    docs = [(d, t) for d, t in docs if root[d] == d]
    yield docs
    yield [(d, t) for d, t in docs if not any(may_overlap(t, i) and test_seeds.brute(t, i) for i in items)]


def test_stages_against_plain_versions(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(200).collect()]
    docs, columns = source, source.columns
    want = plain([(r.doc_id, r.text) for r in source.collect()], items)
    for (name, function), expected in zip(corpus_pipeline.STAGES[:-1], want):
        docs = function(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(expected), name
    assert test_packing.check(expected, corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()) < 0.05


def test_odd_rows_go_through_all_stages(spark, rows):
    a = " ".join(f"w{i}" for i in range(30))
    made = [(1, a), (2, a.upper()), (2, a.upper()), (3, None), (4, ""), (5, "12 34"), (6, a + " x"), (None, "y z"), (7, "long " * 20_000)]
    docs = rows("doc_id long, text string, lang string, source string, n_chars long", [(*m, "en", "s", 1) for m in made])
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, FOLDER)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["2", "7", "None"]
    assert corpus_pipeline.packing(spark, docs.limit(0), FOLDER).collect() == []


def test_registered():
    names = set(entry.queries())
    assert {"pipeline", *QUERIES} <= names and len([n for n in QUERIES if n.startswith("op")]) == 13
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "decontamination", "packing"]


def test_run(spark):
    pieces = corpus_pipeline.run(spark, FOLDER)
    assert pieces.count() > 50 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns)
