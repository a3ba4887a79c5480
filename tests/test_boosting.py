from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foliolens.operators import boosting
from foliolens.operators import training as tr
from foliolens.operators.boosting import LEAF, SoftmaxBoostedModel, SoftmaxBoosting, Trees, binned, grow, histogram, softmax

SCHEMA = "id long, features array<double>, class int"


def table(rows, x, y):
    made = rows(SCHEMA, [(i, [float(v) for v in f], None if c is None else int(c)) for i, (f, c) in enumerate(zip(x, y))])
    return made.withColumn("features", array_to_vector("features"))


def plain_round(x, y, scores, borders, depth, rate, smoothing=1.0, least=1.0):
    """One round by looking at every row for every split, node by node."""
    classes = scores.shape[1]
    share = softmax(scores)
    out = scores.copy()
    for k in range(classes):
        g = share[:, k] - (y == k)
        h = 2 * share[:, k] * (1 - share[:, k])

        def walk(rows, level):
            best = None
            whole = g[rows].sum() ** 2 / (h[rows].sum() + smoothing)
            if level < depth:
                for f, cuts in enumerate(borders):
                    for c in cuts:
                        a, b = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                        if h[a].sum() < least or h[b].sum() < least:
                            continue
                        gain = g[a].sum() ** 2 / (h[a].sum() + smoothing) + g[b].sum() ** 2 / (h[b].sum() + smoothing) - whole
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                            best = gain, a, b
            if best is None:
                out[rows, k] -= rate * g[rows].sum() / (h[rows].sum() + smoothing)
            else:
                walk(best[1], level + 1)
                walk(best[2], level + 1)

        walk(np.arange(len(x)), 0)
    return out


def test_rounds_against_plain_splits():
    random = np.random.default_rng(1)
    x = random.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 0] > 4) + (x[:, 1] * x[:, 2] > 20)).astype(int)
    borders = [np.unique(x[:, f])[:-1] for f in range(3)]
    bins, scores, want = binned(x, borders), np.zeros((400, 3)), np.zeros((400, 3))
    for _ in range(4):
        trees = Trees(3, 3)
        for level in range(3):
            halves = [histogram(trees, level, 10)((bins[s], y[s], scores[s])) for s in (slice(0, 150), slice(150, 400))]
            if not grow(trees, level, halves[0] + halves[1], level == 2, 0.3, 1.0, 1.0):
                break
        scores = trees.add_to(scores, bins)
        want = plain_round(x, y, want, borders, 3, 0.3)
        assert np.allclose(scores, want)
    assert (scores.argmax(axis=1) == y).mean() > 0.9


def test_log_loss_is_below_one_against_the_rest(rows):
    """On the same split, with as many rounds and levels."""
    random = np.random.default_rng(5)
    x = random.normal(size=(1500, 4))
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1] ** 2 + random.normal(0, 0.4, 1500), [-0.5, 0.3, 1.2])
    train, test = table(rows, x[:1000], y[:1000]), table(rows, x[1000:], y[1000:])
    model = SoftmaxBoosting(rounds=25, depth=3, rate=0.2).fit(train)
    share = np.array([r.probability for r in model.transform(test).orderBy("id").collect()])
    held = y[1000:]
    loss = -np.log(share[np.arange(len(held)), held]).mean()
    other = tr.boosted_trees(rounds=25, depth=3, rate=0.2).fit(train.withColumn("class", F.col("class").cast("double")))
    raw = np.array([r.rawPrediction.toArray() for r in other.transform(test).orderBy("id").collect()])
    ones = 1 / (1 + np.exp(-2 * raw))  # each model's own probability of its class
    rest = ones / ones.sum(axis=1, keepdims=True)
    assert loss < -np.log(np.maximum(rest[np.arange(len(held)), held], 1e-15)).mean()
    counts = np.bincount(held)
    assert (share.argmax(axis=1) == held).mean() > counts.max() / len(held) + 0.2
    assert np.allclose(share.sum(axis=1), 1)


def test_layout_of_the_rows_does_not_matter(rows, monkeypatch):
    random = np.random.default_rng(2)
    x = random.integers(0, 6, (500, 2)).astype(float)
    y = (x.sum(axis=1) > 5).astype(int)
    once = SoftmaxBoosting(rounds=5, depth=3).fit(table(rows, x, y))
    monkeypatch.setattr("foliolens.operators.blocked.blocks.__defaults__", (37,))
    again = SoftmaxBoosting(rounds=5, depth=3).fit(table(rows, x, y).repartition(5))
    for a, b in zip(once.rounds, again.rounds):
        assert (a.feature == b.feature).all() and (a.border == b.border).all() and np.allclose(a.value, b.value)


def test_scores_survive_many_rounds(rows, monkeypatch):
    """Past the rounds after which scores are written out."""
    monkeypatch.setattr("foliolens.operators.boosting.KEEP_EVERY", 3)
    x = np.arange(60).reshape(-1, 1).astype(float)
    y = (np.arange(60) // 20).astype(int)
    model = SoftmaxBoosting(rounds=10, depth=2, rate=0.5, least=0.1).fit(table(rows, x, y))
    scores, want = np.zeros((60, 3)), np.zeros((60, 3))
    for trees in model.rounds:
        scores = trees.add_to(scores, binned(x, model.borders))
        want = plain_round(x, y, want, model.borders, 2, 0.5, least=0.1)
    assert np.allclose(scores, want)


def test_save_and_load_in_a_pipeline(rows, tmp_path):
    frame = rows("a double, b double, class double", [(float(i % 7), float(i % 3), float(i % 3)) for i in range(90)])
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features"), tr.softmax_trees(rounds=4, depth=2, classes=4)]
    model = Pipeline(stages=stages).fit(frame)
    tr.save(model, str(tmp_path / "m"))
    again = tr.load(str(tmp_path / "m"))
    assert isinstance(again, PipelineModel) and isinstance(again.stages[-1], SoftmaxBoostedModel)
    key = lambda m: sorted((r.a, r.b, r.prediction, tuple(r.probability)) for r in m.transform(frame).collect())
    assert key(again) == key(model)
    assert all(r.prediction == r["class"] and len(r.probability) == 4 for r in model.transform(frame).collect())


def test_odd_rows(rows):
    nan = float("nan")
    x = [[nan, 1.0], [2.0, 1.0], [nan, 1.0], [3.0, 1.0]] * 20
    made = table(rows, x, [0, 1, 0, None] * 20)
    model = SoftmaxBoosting(rounds=5, depth=2, least=0.1).fit(made)
    assert {(r["class"], r.prediction) for r in model.transform(made).collect()} == {(0, 0.0), (1, 1.0), (None, 1.0)}
    empty = made.limit(0)
    assert model.transform(empty).collect() == []
    nothing = SoftmaxBoosting(rounds=3, classes=2).fit(empty)
    assert nothing.rounds == [] and [r.prediction for r in nothing.transform(made.limit(1)).collect()] == [0.0]
    one = SoftmaxBoosting(rounds=3).fit(made.where("class = 0"))
    assert one.rounds == [] and {tuple(r.probability) for r in one.transform(made).collect()} == {(1.0,)}
    constant = SoftmaxBoosting(rounds=2, classes=2).fit(table(rows, [[1.0]] * 10, [0, 1] * 5))
    assert (constant.rounds[0].feature == LEAF).all()
    with pytest.raises(ValueError):
        SoftmaxBoosting(bins=1000)


def test_blocks_of_a_task_are_summed_together(monkeypatch):
    """Histograms of one large block are those of its small ones, at every level, also where rows have stopped above."""
    random = np.random.default_rng(6)
    small = [(np.asfortranarray(random.integers(0, 9, (50, 3)).astype(np.uint8)), random.integers(0, 3, 50), random.normal(size=(50, 3))) for _ in range(10)]
    (large,) = boosting._joined(iter(small))
    assert len(large[1]) == 500
    trees = Trees(3, 4)
    for level in range(4):
        want = sum(histogram(trees, level, 11)(b) for b in small)
        assert np.allclose(histogram(trees, level, 11)(large), want)
        if not grow(trees, level, want, level == 3, 0.3, 1.0, 8.0):
            break
    assert (trees.feature[:, 1:7] == LEAF).any() and (trees.feature[:, 1:7] != LEAF).any()
    monkeypatch.setattr(boosting, "ROWS_PER_SUM", 120)
    assert [len(b[1]) for b in boosting._joined(iter(small))] == [100] * 5 and list(boosting._joined(iter([]))) == []
