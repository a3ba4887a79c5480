"""Spark ML's perceptron, trained on blocks: the sums of a pass are matrix products over thousands of rows at a time.

Topology, loss (mean log loss of a softmax over sigmoid layers), first weights, L-BFGS and its rules for stopping are those of
`MultilayerPerceptronClassifier`, and the fitted model is Spark ML's own, made from the weights found here.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.operators.blocked import blocks, total
from foliolens.plans.lineage import cut
from foliolens.plans.shipping import by_value

#: Steps that L-BFGS remembers, and values among which it looks for progress.
MEMORY, VALUES = 10, 20
#: Rows of a block that are worked on at a time.
PIECE = 1024


def parts(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the flat weights: per layer a matrix (inputs x outputs) and the intercepts, in Spark ML's order."""
    found, at = [], 0
    for inputs, outputs in zip(layers, layers[1:]):
        end = at + inputs * outputs
        found.append((weights[at:end].reshape(inputs, outputs), weights[end : end + outputs]))
        at = end + outputs
    return found


def gradient(weights: np.ndarray, layers: list[int]):
    """Of one block (inputs x rows, labels): the gradient of its loss, then the loss and the number of rows."""

    def of(block) -> np.ndarray:
        x, labels = block
        x = x.astype(np.float32, copy=False)
        model, out, held = parts(weights.astype(np.float32), layers), np.zeros(len(weights) + 2), {}
        # Pieces whose activities stay in a cache, in arrays made once; single precision within a piece, double across them.
        for first in range(0, len(labels), PIECE):
            chosen = labels[first : first + PIECE]
            n = len(chosen)
            if n not in held:
                held[n] = [*([np.empty((width, n), np.float32) for width in widths] for widths in (layers[1:], layers[1:-1]))]
            _add_piece(out, model, layers, x[:, first : first + PIECE], chosen, *held[n])
        return out

    return of


def _add_piece(out: np.ndarray, model: list, layers: list[int], x: np.ndarray, labels: np.ndarray, activity: list, back: list) -> None:
    before = x
    for (matrix, intercept), z in zip(model, activity):
        np.matmul(matrix.T, before, out=z)
        z += intercept[:, None]
        if z is not activity[-1]:
            with np.errstate(over="ignore"):
                np.exp(np.negative(z, out=z), out=z)
            z += np.float32(1)
            np.reciprocal(z, out=z)
        before = z
    z, rows = activity[-1], np.arange(len(labels))
    z -= z.max(axis=0)
    chosen = z[labels, rows].sum(dtype=np.float64)
    np.exp(z, out=z)
    sums = z.sum(axis=0)
    out[-2:] += np.log(sums).sum(dtype=np.float64) - chosen, len(labels)
    z /= sums
    z[labels, rows] -= np.float32(1)
    for number in range(len(model) - 1, -1, -1):
        slopes, before = parts(out, layers)[number], activity[number - 1] if number else x
        slopes[0][:] += before @ z.T
        slopes[1][:] += z.sum(axis=1)
        if number:
            behind = np.matmul(model[number][0], z, out=back[number - 1])
            behind *= before
            np.subtract(np.float32(1), before, out=before)
            behind *= before
            z = behind


def minimise(value: Callable, start: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """L-BFGS with a line search for the strong Wolfe conditions; `value` gives loss and gradient.

    Ends after so many rounds, when the gradient is small against the loss, or when the loss is hardly below the highest of the last `VALUES`.
    """
    x, (loss, slope) = start, value(start)
    first, seen, steps = abs(loss), deque([loss], VALUES), deque([], MEMORY)
    for number in range(rounds):
        if not np.isfinite(loss) or np.linalg.norm(slope) <= max(tolerance * abs(loss), 1e-8):
            break
        way = -_curved(slope, steps)
        if way @ slope >= 0:
            way, steps = -slope, deque([], MEMORY)
        found = _search(value, x, loss, slope, way, 1.0 if number else 1.0 / np.linalg.norm(slope))
        if found is None:
            if not steps:
                break
            steps.clear()
            continue
        x_next, loss, slope_next = found
        s, y = x_next - x, slope_next - slope
        if s @ y > 1e-12 * (y @ y):
            steps.append((s, y, 1.0 / (s @ y)))
        x, slope = x_next, slope_next
        highest = max(seen)
        seen.append(loss)
        if abs(loss - highest) <= tolerance * first:
            break
    return x


def _curved(slope: np.ndarray, steps: deque) -> np.ndarray:
    """The gradient through the inverse curvature that the last steps tell."""
    q, shares = slope.copy(), []
    for s, y, r in reversed(steps):
        a = r * (s @ q)
        q -= a * y
        shares.append(a)
    if steps:
        s, y, _ = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y, r), a in zip(steps, reversed(shares)):
        q += (a - r * (y @ q)) * s
    return q


def _search(value: Callable, x, loss: float, slope, way, step: float, most: int = 20):
    """A point along the way that lowers the loss enough and has left most of its slope behind; None if there is none."""
    down, low, high, best = way @ slope, 0.0, np.inf, None
    for _ in range(most):
        at = x + step * way
        reached, there = value(at)
        if not np.isfinite(reached) or reached > loss + 1e-4 * step * down:
            high = step
        else:
            best = at, reached, there
            along = there @ way
            if abs(along) <= 0.9 * -down:
                break
            low, high = (step, high) if along < 0 else (low, step)
        step = 2 * low if high == np.inf else (low + high) / 2
    return best


def _pack(batch: pd.DataFrame):
    return np.stack(batch["x"].to_list(), axis=1).astype(np.float32), batch["y"].to_numpy(np.int64)


class Perceptron(Estimator, HasFeaturesCol, HasLabelCol):
    """A perceptron of the given layers, trained in at most `rounds` rounds over all rows; gives Spark ML's model."""

    @keyword_only
    def __init__(self, *, layers: list[int], rounds: int = 100, tolerance: float = 1e-6, seed: int = 42, featuresCol: str = "features", labelCol: str = "class"):
        super().__init__()
        self.layers, self.rounds, self.tolerance, self.seed = layers, rounds, tolerance, seed
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        by_value(gradient), by_value(blocks), by_value(cut)
        spark, layers = dataset.sparkSession, self.layers
        # Spark ML's classifier in no rounds: its first weights, and at the end its model of the weights found.
        still = MultilayerPerceptronClassifier(
            layers=layers, maxIter=0, seed=self.seed, featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol()
        )
        one = spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], [self.getFeaturesCol(), self.getLabelCol()])
        rows = cut(dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")))
        data = blocks(rows, by_value(_pack), "perceptron", even=True)

        def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
            sums = total(data, gradient(weights, layers), depth=1)
            n = sums[-1] if sums is not None else 0.0
            return (sums[-2] / n, sums[:-2] / n) if n else (0.0, np.zeros(len(weights)))

        found = minimise(value, still.fit(one).weights.toArray(), self.rounds, self.tolerance)
        data.unpersist()
        return still.copy().setInitialWeights(Vectors.dense(found)).fit(one)
