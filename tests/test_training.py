from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from foliolens.operators import training as tr


def test_report_with_empty_classes(rows):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "c")]
    report = {r["class"]: r for r in tr.classification_report(rows("l string, p string", pairs), "l", "p", ["a", "b", "c", "d"]).collect()}
    assert (report["a"].precision, report["a"].recall, report["a"].support) == (1.0, 0.75, 4)
    assert report["b"].f1 == pytest.approx(2 / 3)
    assert (report["c"].precision, report["c"].recall, report["c"].f1, report["d"].f1) == (0.0, 0.0, 0.0, 0.0)
    assert report["accuracy"].f1 == pytest.approx(5 / 7)
    assert report["macro avg"].recall == pytest.approx((0.75 + 2 / 3) / 4)
    assert report["weighted avg"].recall == pytest.approx(5 / 7)
    assert report["macro avg"].support == 7


def test_scaling_uses_population_deviation(rows):
    values = [1.0, 2.0, 4.0, 9.0]
    frame = rows("x double, c double", [(v, 5.0) for v in values])
    scaled = tr.Scaling(frame, ["x", "c"]).transform(frame).orderBy("x").collect()
    mean, deviation = statistics.mean(values), statistics.pstdev(values)
    assert [r.x for r in scaled] == pytest.approx([(v - mean) / deviation for v in values])
    assert {r.c for r in scaled} == {0.0}


def test_splits(spark):
    frame = spark.range(1000).select("id", F.when(F.col("id") < 900, "a").otherwise("b").alias("label"))
    simple = {r.id: r.part for r in tr.split(frame, ["id"]).collect()}
    again = {r.id: r.part for r in tr.split(frame.repartition(7), ["id"]).collect()}
    assert simple == again
    assert 740 < sum(p == "train" for p in simple.values()) < 860
    exact = tr.split_stratified(frame, ["id"]).groupBy("label", "part").count().collect()
    assert {(r.label, r.part): r["count"] for r in exact} == {
        ("a", "train"): 720, ("a", "test"): 180, ("b", "train"): 80, ("b", "test"): 20,
    }


@pytest.fixture
def examples(spark):
    size = F.pmod(F.col("id") * 7, F.lit(4))
    return spark.range(120).select(
        F.col("id").alias("line_idx"), F.lit(1).alias("doc_id"), (10.0 + 2 * size).alias("font_size"),
        F.lit(0).alias("bold"), (F.col("id") % 5).cast("double").alias("top"), F.lit(1.0).alias("spacing"), size.cast("int").alias("class"),
    )


@pytest.mark.parametrize("kind", ["forest", "boosted", "perceptron"])
def test_models_learn_and_reload(examples, kind, tmp_path):
    estimator = {
        "forest": lambda: tr.random_forest(trees=5, depth=5),
        "boosted": lambda: tr.boosted_trees(rounds=3, depth=3),
        "perceptron": lambda: tr.perceptron(4, rounds=60),
    }[kind]()
    model = tr.fit(examples, tr.SPAN_FEATURES, estimator, scale=kind != "forest")
    scored = tr.score(examples, model, tr.SPAN_FEATURES).collect()
    levels = {0: "BODY", 1: "H1", 2: "H2", 3: "H3"}
    assert sum(r.level == levels[r["class"]] for r in scored) >= 100
    assert {r.font_size for r in scored} == {10.0, 12.0, 14.0, 16.0}
    tr.save(model, str(tmp_path / "m"))
    again = tr.score(examples, tr.load(str(tmp_path / "m")), tr.SPAN_FEATURES)
    assert sorted((r.line_idx, r.level) for r in again.collect()) == sorted((r.line_idx, r.level) for r in scored)


def test_missing_features_are_zero(rows):
    row = tr.filled(rows("font_size double", [(None,)]), ["font_size", "bold"]).first()
    assert (row.font_size, row.bold) == (0.0, 0.0)


def placed(frame, keys, share, label="label"):
    """The train rows as a window over each label would choose them."""
    order = [tr.SplitKey.of(*keys), *keys]
    window = tr.Window.partitionBy(label)
    numbered = frame.withColumn("_p", F.row_number().over(window.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(window))
    return sorted(map(str, numbered.where(F.col("_p") < F.floor(F.col("_n") * share)).select(*frame.columns).collect()))


@pytest.mark.parametrize("share", [0.0, 0.001, 0.5, 0.8, 1.0])
def test_stratified_split_against_a_window(spark, share):
    frame = spark.range(3000).select("id", (F.col("id") % 3).alias("k"), F.expr("CASE WHEN id < 2500 THEN 'a' WHEN id < 2990 THEN 'b' END").alias("label"))
    got = tr.split_stratified(frame, ["id", "k"], share=share)
    assert got.columns == ["id", "k", "label", "part"] and got.count() == 3000
    assert sorted(map(str, got.where("part = 'train'").drop("part").collect())) == placed(frame, ["id", "k"], share)


def test_stratified_split_among_equal_hashes(spark, monkeypatch):
    """With few hashes the border runs through rows of one hash; equal keys are split by number."""
    plain = tr.SplitKey.of
    monkeypatch.setattr(tr.SplitKey, "of", staticmethod(lambda *keys, seed=42: plain(*keys, seed=seed) % 3 * 70_000))
    frame = spark.range(1000).select("id", F.lit("a").alias("label"))
    got = tr.split_stratified(frame, ["id"])
    assert sorted(map(str, got.where("part = 'train'").drop("part").collect())) == placed(frame, ["id"], 0.8)
    same = spark.range(900).select((F.col("id") % 2).alias("id"), F.when(F.col("id") < 300, "x").otherwise("y").alias("label"), F.col("id").alias("extra"))
    counts = {(r.label, r.part): r["count"] for r in tr.split_stratified(same, ["id"]).groupBy("label", "part").count().collect()}
    assert counts == {("x", "train"): 240, ("x", "test"): 60, ("y", "train"): 480, ("y", "test"): 120}
    assert tr.split_stratified(same, ["id"]).select("extra").distinct().count() == 900
    assert tr.split_stratified(same.limit(0), ["id"]).collect() == []


def test_no_window_sees_the_rows_of_a_label(spark):
    frame = spark.range(100).select("id", F.lit("a").alias("label"))
    plan = tr.split_stratified(frame, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_candidates_of_a_line_model_are_found_once(spark, monkeypatch):
    """For training and for the outlines; words are classed on what passes the filters, with the same counts as on all lines."""
    import __spark_entry__ as entry
    from foliolens.catalog.base import Tables
    from foliolens.operators import candidates as cd
    from tests.conftest import FOLDER

    t = Tables(spark, FOLDER)
    late, early = cd.candidates(t.features, words=True), cd.candidates(t.all_features)
    names = sorted(early.columns)
    assert sorted(late.columns) == names and late.select(names).exceptAll(early.select(names)).isEmpty()
    assert early.count() == late.count() > 0
    calls, plain = [], cd.filter_candidates
    monkeypatch.setattr(cd, "filter_candidates", lambda *a, **k: calls.append(1) or plain(*a, **k))
    entry.queries()["outline_model"](spark, FOLDER)
    assert len(calls) == 1
