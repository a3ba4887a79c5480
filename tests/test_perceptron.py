from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector

from foliolens.operators import training as tr
from foliolens.operators.blocked import blocks
from foliolens.operators.perceptron import gradient, minimise
from foliolens.plans import lineage

LAYERS = [3, 5, 4, 3]


def plain_loss(weights, x, y):
    """Row by row, with Spark ML's order of weights: a layer's matrix column by column, then its intercepts."""
    loss = 0.0
    for row, label in zip(x, y):
        at, a = 0, row
        for inputs, outputs in zip(LAYERS, LAYERS[1:]):
            z = [sum(weights[at + i * outputs + o] * a[i] for i in range(inputs)) + weights[at + inputs * outputs + o] for o in range(outputs)]
            at += (inputs + 1) * outputs
            a = [1 / (1 + np.exp(-v)) for v in z]
        loss += np.log(sum(np.exp(v) for v in z)) - z[label]
    return loss


def example(n=60):
    random = np.random.default_rng(3)
    x = random.normal(size=(n, 3))
    return x, np.digitize(x[:, 0] + x[:, 1] * x[:, 2], [-0.5, 0.6])


def table(rows, x, y):
    made = rows("features array<double>, class double", [([float(v) for v in f], float(c)) for f, c in zip(x, y)])
    return made.withColumn("features", array_to_vector("features"))


def test_gradient_against_differences():
    x, y = example()
    size = sum((i + 1) * o for i, o in zip(LAYERS, LAYERS[1:]))
    weights = np.random.default_rng(4).normal(size=size)
    found = gradient(weights, LAYERS)((x.T, y))
    assert np.isclose(found[-2], plain_loss(weights, x, y)) and found[-1] == len(x)
    for i in range(0, size, 3):
        step = np.eye(size)[i] * 1e-5
        assert np.isclose(found[i], (plain_loss(weights + step, x, y) - plain_loss(weights - step, x, y)) / 2e-5, atol=1e-4)


def test_minimise_finds_the_valley():
    def value(p):
        a, b = p
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(minimise(value, np.array([-1.2, 1.0]), 200, 1e-14), [1, 1], atol=1e-4)


def test_loss_and_model_are_those_of_spark(rows):
    x, y = example(400)
    train = table(rows, x, y)
    model = tr.Perceptron(layers=LAYERS, rounds=80, seed=7).fit(train)
    other = MultilayerPerceptronClassifier(layers=LAYERS, maxIter=80, seed=7, labelCol="class").fit(train)
    loss = lambda m: gradient(m.weights.toArray(), LAYERS)((x.T, y))[-2] / len(x)
    assert isinstance(model, MultilayerPerceptronClassificationModel)
    assert loss(model) <= loss(other) * 1.05 + 1e-3
    start = MultilayerPerceptronClassifier(layers=LAYERS, maxIter=0, seed=7, labelCol="class").fit(train)
    assert np.array_equal(tr.Perceptron(layers=LAYERS, rounds=0, seed=7).fit(train).weights.toArray(), start.weights.toArray())


def test_a_pass_costs_little_for_each_row():
    """A pass of Spark ML's trainer took 3.3 us a row at the layers of train_mlp."""
    layers, n = [4, 32, 16, 4], 4096
    random = np.random.default_rng(5)
    block = random.normal(size=(4, n)), random.integers(0, 4, n)
    weights = random.normal(size=sum((i + 1) * o for i, o in zip(layers, layers[1:])))
    of, best = gradient(weights, layers), np.inf
    for _ in range(20):
        start = time.perf_counter()
        of(block)
        best = min(best, time.perf_counter() - start)
    assert best / n < 2.5e-6


def test_rows_of_few_tasks_are_dealt_to_all_cores(spark):
    rows = spark.range(40).coalesce(1)
    made = blocks(rows, lambda b: len(b), "even", 4, even=True)
    assert sum(made.collect()) == 40
    assert len(spark.read.parquet(lineage._written[-1]).inputFiles()) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("n", [0, 1])
def test_no_row_and_one_row(rows, n):
    x, y = example(n) if n else (np.zeros((0, 3)), np.zeros(0, int))
    model = tr.Perceptron(layers=LAYERS, rounds=5).fit(table(rows, x, y))
    assert np.isfinite(model.weights.toArray()).all()
