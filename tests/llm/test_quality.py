from __future__ import annotations

import numpy as np

from foliolens.llm import quality
from foliolens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_coordinate_descent_meets_the_optimality_conditions():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.3 * draw.normal(size=80) > 0, 1.0, -1.0)
    rows = [np.arange(6)] * 80
    w = quality.dual_coordinate_descent(rows, list(x), y, 6, rounds=3000)
    bound = {s: len(y) / (2 * (y == s).sum()) for s in (1.0, -1.0)}

    def loss(v):
        hinge = np.maximum(0, 1 - y * (x @ v[:-1] + v[-1]))
        return 0.5 * v @ v + sum(bound[s] * hinge[y == s].sum() for s in bound)

    least = loss(w)
    for _ in range(300):
        assert loss(w + 0.05 * draw.normal(size=7)) >= least - 1e-3


def test_log_count_ratio():
    rows = [np.array([1, 2]), np.array([1]), np.array([3])]
    ratio = quality.log_count_ratio(rows, np.array([True, True, False]))
    good, bad = quality.BUCKETS + 3, quality.BUCKETS + 1
    assert np.isclose(ratio[1], np.log(3 / good / (1 / bad)), atol=1e-5)
    assert np.isclose(ratio[3], np.log(1 / good / (2 / bad)), atol=1e-5)


def test_indicators_are_those_of_each_text_alone():
    texts = ["One two two three!", "", "ÉA bb", "one"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    row, bucket = quality.indicators(offsets, data)
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        alone = quality.indicators(np.array([0, len(raw)]), raw)[1]
        assert list(bucket[row == i]) == list(alone)
        assert len(set(alone)) == len(alone)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [d for d in labels if got[d].held_out]
    assert len(got) == 1000 and len(held) > 50
    assert np.mean([got[d].predicted == labels[d] for d in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_odd_rows(spark, rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    odd = rows("doc_id long, text string, quality int, x int", [(1, None, 1, 0), (1, "", 0, 0), (2, "word " * 100_000, 1, 0), (None, "!", 1, 0)])
    got = quality.score_quality(odd, model, "s").collect()
    assert got[0].s == got[1].s and all(0 <= r.s <= 1 for r in got)
    assert quality.score_quality(odd.limit(0), model, "s").collect() == []


def test_nothing_to_learn_from(rows):
    docs = rows("doc_id long, text string", [(1, "a"), (2, "b")])
    for labels in ([], [(1, 1), (2, 1)], [(None, 1), (1, None)]):
        model = quality.fit(docs, rows("doc_id long, quality int", labels))
        assert model is None and {r.score for r in quality.score_quality(docs, model).collect()} == {0.5}
