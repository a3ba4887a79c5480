from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foliolens.catalog import learning as le
from foliolens.catalog.base import Tables
from foliolens.operators import blocked
from foliolens.operators import lines as ln
from foliolens.operators import network as nw
from foliolens.operators import training as tr
from tests.conftest import FOLDER


class Sent:
    def __init__(self, value):
        self.value = value


def small(random, units=3, buckets=16, inputs=2, classes=3):
    return [
        random.normal(size=(buckets, units)), random.normal(size=(inputs, units)), random.normal(size=units),
        random.normal(size=(units, classes)), random.normal(size=classes),
    ]


def test_gradient_against_differences(monkeypatch):
    monkeypatch.setattr(nw, "PIECE", 7)
    random = np.random.default_rng(0)
    weights, idf = small(random), random.random(16) + 0.5
    ids = [random.integers(0, 16, n) for n in (4, 0, 9, 1, 30)]
    block = (*nw.rows_of(ids, idf), random.normal(size=(5, 2)), random.integers(0, 3, 5), np.array([False, False, True, False, False]))
    figures, *slopes = nw.gradient(Sent(weights))(block)
    assert figures[1] == 4 and figures[3] == 1
    for i, w in enumerate(weights):
        for at in list(np.ndindex(w.shape))[:40]:
            losses = []
            for step in (1e-6, -1e-6):
                moved = [v.copy() for v in weights]
                moved[i][at] += step
                losses.append(nw.gradient(Sent(moved))(block)[0][0])
            assert slopes[i][at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-4)


def test_rows_are_counts_times_idf_of_length_one():
    idf = np.arange(1, 6, dtype=float)
    bucket, weight, first = nw.rows_of([np.array([1, 1, 3]), np.array([], int), np.array([0])], idf)
    assert bucket.tolist() == [1, 3, 0] and first.tolist() == [0, 2, 2, 3]
    assert weight == pytest.approx(np.array([4, 4, 32**0.5]) / 32**0.5)


def test_no_word_is_left_out(spark):
    """More words than buckets: each word still has its two rows."""
    words = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("w")).agg(F.collect_list("w").alias("words"))
    ids = words.select(nw.buckets_of("words", 1 << 10).alias("ids")).first().ids
    assert len(ids) == 10_000 and min(ids) >= 0 and max(ids) < 1 << 10 and len(set(ids)) == 1 << 10
    assert nw.buckets_of("words", 8) is not None
    null = spark.sql("SELECT cast(null AS array<string>) AS words").select(nw.buckets_of("words", 8).alias("ids")).first().ids
    assert null == []


def losses(model, test):
    scored = model.transform(tr.filled(test, tr.LAYOUT_FEATURES))
    share = F.col("probability") if dict(scored.dtypes)["probability"].startswith("array") else nw.vector_to_array("probability")
    row = scored.agg(
        F.avg(-F.log(F.greatest(F.lit(1e-15), share[F.col("class").cast("int")]))), F.avg((F.col("prediction") == F.col("class")).cast("double"))
    ).first()
    return tuple(row)


def test_beats_the_logistic_model_on_held_out_rows(spark):
    t = Tables(spark, FOLDER.replace("0.001", "0.01"))
    rows = tr.text_training_set(ln.with_page_context(t.features), t.labels)
    train, test = le._parts(rows.select("doc_id", "line_idx", "text", *tr.LAYOUT_FEATURES, "class"), ["doc_id", "line_idx"])
    loss, accuracy = losses(tr.fused_classifier(train), test)
    plain_loss, plain_accuracy = losses(tr.text_layout_classifier(train), test)
    assert loss < plain_loss - 0.05 and accuracy >= plain_accuracy


def made(rows, n=300):
    data = [(i, ["up" if i % 3 else "down", f"word{i % 41}"], [float(i % 2), 1.0], int(i % 3 > 0) ^ i % 2) for i in range(n)]
    return rows("id long, words array<string>, x array<double>, class int", data).withColumn("layout", array_to_vector("x"))


def test_learns_what_no_linear_model_can(rows):
    """A class that depends on a word and a layout column together (exclusive or)."""
    frame = made(rows)
    network = nw.FusedNetwork(buckets=256, units=16, rounds=150, rate=0.05, decay=1e-3, patience=150)
    model = network.fit(frame)
    assert network.losses[-1][0] < network.losses[0][0]
    right = [r.prediction == r["class"] for r in model.transform(frame).collect()]
    assert np.mean(right) > 0.95


def test_training_does_not_depend_on_the_layout(rows):
    frame = made(rows, 120)
    a = nw.FusedNetwork(buckets=64, units=4, rounds=5).fit(frame)
    b = nw.FusedNetwork(buckets=64, units=4, rounds=5).fit(frame.repartition(7))
    assert all(np.allclose(x, y, atol=1e-4) for x, y in zip(a.weights, b.weights))


def test_save_and_load(rows, tmp_path):
    frame = made(rows, 60)
    model = Pipeline(stages=[nw.FusedNetwork(buckets=32, units=4, rounds=3, classes=6)]).fit(frame)
    tr.save(model, str(tmp_path / "m"))
    key = lambda m: sorted((r.id, r.prediction, tuple(np.round(r.probability, 6))) for r in m.transform(frame).collect())
    again = tr.load(str(tmp_path / "m"))
    assert key(again) == key(model) and len(model.transform(frame).first().probability) == 6


def test_odd_rows(rows):
    schema = "words array<string>, x array<double>, class int"
    data = [(None, [0.0], 0), ([], [1.0], 1), (["a"] * 50_000, [0.0], 0), ([f"w{i}" for i in range(30_000)], [float("nan")], 1), (["a"], [0.0], None)] * 4
    frame = rows(schema, data).withColumn("layout", array_to_vector("x"))
    model = nw.FusedNetwork(buckets=64, units=4, rounds=3).fit(frame)
    assert model.transform(frame).count() == 20 and np.isfinite(model.weights[0]).all()
    empty = nw.FusedNetwork(buckets=64, units=4, rounds=3, classes=2).fit(frame.limit(0))
    assert [len(r.probability) for r in empty.transform(frame.limit(0)).collect()] == []


def test_report_of_a_trained_model(spark):
    """Precision, recall, F1 and accuracy of a model's held-out rows, from the rows themselves."""
    t = Tables(spark, FOLDER)
    train, test = le._parts(le.span_examples(t), le.SPAN_KEYS)
    model = tr.fit(train, tr.SPAN_FEATURES, tr.softmax_trees(rounds=8, depth=4))
    report = {r["class"]: r for r in le.report_of(model, test, tr.SPAN_FEATURES).collect()}
    names = dict(enumerate(le.lb.LEVELS))
    pairs = [(names[r["class"]], r.level) for r in tr.score(test, model, tr.SPAN_FEATURES).collect()]
    for c in names.values():
        hits, found, support = sum(a == b == c for a, b in pairs), sum(b == c for _, b in pairs), sum(a == c for a, _ in pairs)
        p, r = hits / found if found else 0.0, hits / support if support else 0.0
        assert (report[c].precision, report[c].recall, report[c].support) == (pytest.approx(p), pytest.approx(r), support)
        assert report[c].f1 == pytest.approx(2 * p * r / (p + r) if p + r else 0.0)
    assert report["accuracy"].f1 == pytest.approx(np.mean([a == b for a, b in pairs]))


def test_guessing_is_not_enough(rows):
    schema = "class string, precision double, recall double, f1 double, support long"
    classes = [("a", 0.0, 0.0, 0.0, 90), ("b", 0.0, 0.0, 0.0, 10)]
    for accuracy, want in ((0.9, False), (0.905, False), (0.911, True)):
        assert le.better_than_guessing(rows(schema, [*classes, ("accuracy", accuracy, accuracy, accuracy, 100)])) is want


def test_sums_over_blocks_keep_to_one_array_and_pieces_to_a_cache():
    """One table of the size of the weights per task, and products of a piece with 64 weights of four bytes in 4 MB at most."""
    random = np.random.default_rng(2)
    a, b = [random.random((4, 3)), random.random(2)], [random.random((4, 3)), random.random(2)]
    expected, kept = [x + y for x, y in zip(a, b)], a[0]
    added = blocked._add(a, b)
    assert all((x == y).all() for x, y in zip(added, expected)) and added[0] is kept
    assert blocked._add(None, b) is b and blocked._add(a, None) is a
    assert nw.PIECE * 64 * 4 <= 4 << 20
    for buckets in (1 << 14, 1 << 20):
        ids = random.integers(0, buckets, 5000).astype(np.int32)
        assert (blocked.by_bucket(ids, buckets) == np.argsort(ids, kind="stable")).all()


@pytest.mark.parametrize("columns", [0, 3, 2048])
def test_frequent_and_rare_buckets_count_the_same(monkeypatch, columns):
    monkeypatch.setattr(nw, "COLUMNS", columns)
    monkeypatch.setattr(nw, "PIECE", 7)
    random = np.random.default_rng(5)
    ids = [np.concatenate([random.integers(0, 40, n), np.zeros(min(n, 1), int)]) for n in (0, 3, 1, 60, 9, 0, 2, 5)]
    bucket, weight, first = nw.rows_of(ids, random.uniform(1, 2, 40))
    plain = np.zeros((len(ids), 40))
    plain[np.repeat(np.arange(len(ids)), np.diff(first)), bucket] = weight
    words, table, back = nw.Words(bucket, weight, first, 40), random.normal(size=(40, 4)), random.normal(size=(len(ids), 4))
    assert len(words.often) == min(columns, len(words.often)) and np.allclose(words.times(table), plain @ table, atol=1e-5)
    assert np.allclose(words.transposed(back), plain.T @ back, atol=1e-5)


def test_all_cores_have_a_share_of_each_pass(spark, monkeypatch):
    """However few tasks the rows come in."""
    seen, plain = [], nw.total
    monkeypatch.setattr(nw, "total", lambda data, function: seen.append(data.getNumPartitions()) or plain(data, function))
    frame = spark.range(3 * 4096).coalesce(1).select(
        F.array(F.col("id").cast("string")).alias("words"), F.lit(None).cast("double").alias("n"), (F.col("id") % 2).cast("double").alias("class")
    )
    layout = nw.F.expr("array(cast(class as double))")
    from pyspark.ml.functions import array_to_vector

    nw.FusedNetwork(buckets=32, units=2, rounds=1).fit(frame.withColumn("layout", array_to_vector(layout)))
    assert seen == [3]
