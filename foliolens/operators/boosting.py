"""Multi-class boosted trees: one softmax over all classes, one pass over the data per tree level for all of them.

Features are cut at sampled quantiles into at most 255 bins.  A pass sums gradients and curvatures by (class, node, feature, bin), so what
returns to the driver depends on the shape of the trees alone, never on the number of rows; the driver picks the splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.operators.blocked import Saved, blocks, total
from foliolens.plans.lineage import cut, shared_folder
from foliolens.plans.shipping import by_value

#: Rounds between writes of the scores to the shared folder, which bounds what a lost executor costs.
KEEP_EVERY = 16
#: Rows that a task puts into one histogram at a time.
ROWS_PER_SUM = 1 << 15
#: Histograms of all tasks that the driver may add up itself.
SMALL_BYTES = 4 << 20
LEAF = -1


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def binned(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    """Bin 0 of a feature holds missing values, each other one the values above a border and up to the next."""
    columns = [np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(b, x[:, f], "left")) for f, b in enumerate(borders)]
    return np.stack(columns, axis=1).astype(np.uint8) if columns else np.zeros((len(x), 0), np.uint8)


class Trees:
    """The trees of one round, one per class, as arrays of nodes; children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, classes: int, depth: int):
        nodes = (1 << depth + 1) - 1
        self.feature = np.full((classes, nodes), LEAF, np.int16)
        self.border = np.zeros((classes, nodes), np.uint8)
        self.value = np.zeros((classes, nodes), np.float64)

    def nodes(self, bins: np.ndarray, steps: int) -> np.ndarray:
        """The node of each row in each class's tree after so many steps down; rows at a leaf stay there."""
        rows, flat = np.arange(len(bins)), bins.ravel(order="F")
        out = np.zeros((len(self.feature), len(bins)), np.int64)
        for k, at in enumerate(out):
            leaf, column = self.feature[k] == LEAF, np.maximum(self.feature[k], 0).astype(np.int64) * len(bins)
            for step in range(steps):
                down = 2 * at + 1
                down += flat.take(column.take(at) + rows) > self.border[k].take(at)
                at[:] = np.where(leaf.take(at), at, down) if leaf[: (2 << step) - 1].any() else down
        return out

    def add_to(self, scores: np.ndarray, bins: np.ndarray) -> np.ndarray:
        depth = (self.feature.shape[1] + 1).bit_length() - 2
        at = self.nodes(bins, depth)
        return scores + np.stack([self.value[k].take(at[k]) for k in range(len(at))]).T


def histogram(trees: Trees, level: int, widths: int):
    """Sums of gradient and curvature of one block by class, node of the level, feature and bin."""

    def of(block) -> np.ndarray:
        bins, labels, scores = block
        classes, (rows, features) = scores.shape[1], bins.shape
        raised = np.exp((scores - scores.max(axis=1, keepdims=True)).T)
        share = raised / raised.sum(axis=0)
        slope = share - (labels == np.arange(classes)[:, None])
        curve = np.maximum(2 * share * (1 - share), 1e-16)
        first, count = (1 << level) - 1, 1 << level
        out = np.zeros((2, classes, count, features, widths))
        at = trees.nodes(bins, level) - first
        columns = np.ascontiguousarray(bins.T)
        for k in range(classes):
            here, mine, weights = at[k], columns, (slope[k], curve[k])
            if level and here.min(initial=0) < 0:  # some stopped at a leaf above
                kept = np.flatnonzero(here >= 0)
                here, mine, weights = here[kept], columns[:, kept], (slope[k, kept], curve[k, kept])
            node = here * widths
            for f in range(features):
                cell = node + mine[f]
                for i, weight in enumerate(weights):
                    out[i, k, :, f] = np.bincount(cell, weight, count * widths).reshape(count, widths)
        return out

    return of


def grow(trees: Trees, level: int, sums: np.ndarray, last: bool, rate: float, smoothing: float, least: float) -> bool:
    """Split the nodes of a level where that lowers the loss, and set the values of their children; whether any was split."""
    slope, curve = sums
    classes, count, _, _ = slope.shape
    first, grown = (1 << level) - 1, False
    for k in range(classes):
        for n in range(count):
            whole_s, whole_c = slope[k, n, 0].sum(), curve[k, n, 0].sum()
            if not whole_c:
                continue
            node = first + n
            if level == 0:
                trees.value[k, node] = -rate * whole_s / (whole_c + smoothing)
            left_s, left_c = slope[k, n].cumsum(axis=1)[:, :-1], curve[k, n].cumsum(axis=1)[:, :-1]
            right_s, right_c = whole_s - left_s, whole_c - left_c
            gain = left_s**2 / (left_c + smoothing) + right_s**2 / (right_c + smoothing) - whole_s**2 / (whole_c + smoothing)
            gain = np.where((left_c >= least) & (right_c >= least), gain, 0.0)
            if not gain.size or gain.max() <= 1e-6:
                continue
            f, b = np.unravel_index(gain.argmax(), gain.shape)
            trees.feature[k, node], trees.border[k, node] = f, b
            for child, s, c in ((2 * node + 1, left_s, left_c), (2 * node + 2, right_s, right_c)):
                trees.value[k, child] = -rate * s[f, b] / (c[f, b] + smoothing)
            grown = True
    return grown and not last


def _pack(borders: list[np.ndarray], classes: int):
    def of(batch: pd.DataFrame):
        x = np.stack(batch["x"].to_list()) if len(batch) else np.zeros((0, len(borders)))
        return np.asfortranarray(binned(x, borders)), batch["y"].to_numpy(np.int32), np.zeros((len(batch), classes), order="F")

    return of


def _joined(found: Iterator) -> Iterator:
    """The blocks of a task in larger ones: each block costs a pass over histograms, whose size does not depend on its rows."""
    held: list = []
    for block in found:
        if held and sum(len(h[1]) for h in held) + len(block[1]) > ROWS_PER_SUM:
            yield _one(held)
            held = []
        held.append(block)
    if held:
        yield _one(held)


def _one(held: list):
    bins, labels, scores = zip(*held)
    return np.asfortranarray(np.concatenate(bins)), np.concatenate(labels), np.asfortranarray(np.concatenate(scores))


def _advance(trees: Trees):
    return lambda block: (block[0], block[1], trees.add_to(block[2], block[0]))


class SoftmaxBoosting(Estimator, HasFeaturesCol, HasLabelCol):
    """Gradient boosting of the multi-class log loss with second-order steps.

    `rounds` trees per class of at most `depth` levels, steps scaled by `rate`; `smoothing` is added to the curvature of a leaf and
    children need a curvature of `least`.  Labels are 0, 1, ... without gaps being needed; null labels are left out, missing features
    have a bin of their own below all others.  Ties between splits go to the first feature and border.  A single class, or no row at all, gives constant scores.
    """

    @keyword_only
    def __init__(self, *, rounds: int = 100, depth: int = 6, rate: float = 0.1, bins: int = 64, smoothing: float = 1.0, least: float = 1.0,
                 classes: int | None = None, featuresCol: str = "features", labelCol: str = "class"):
        super().__init__()
        self.settings = {k: v for k, v in self._input_kwargs.items() if not k.endswith("Col")}
        defaults = {"rounds": 100, "depth": 6, "rate": 0.1, "bins": 64, "smoothing": 1.0, "least": 1.0, "classes": None}
        self.settings = {**defaults, **self.settings}
        if not 2 <= self.settings["bins"] <= 255:
            raise ValueError("bins must be 2 to 255")
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, dataset: DataFrame) -> SoftmaxBoostedModel:
        for function in (histogram, blocks, cut):
            by_value(function)
        p = self.settings
        rows = cut(
            dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")).where("y is not null")
        )
        most = rows.agg(F.max("y"), F.max(F.size("x"))).first()
        classes = p["classes"] or (0 if most[0] is None else most[0] + 1)
        shares = [i / p["bins"] for i in range(1, p["bins"])]
        names = [f"x{i}" for i in range(most[1] or 0)]
        wide = rows.select(*(F.nanvl(F.col("x")[i], F.lit(None)).alias(n) for i, n in enumerate(names)))
        cuts = wide.approxQuantile(names, shares, 0.2 / p["bins"]) if names else []
        borders = [np.unique(np.array(c, np.float64)) for c in cuts]
        rounds: list[Trees] = []
        if classes > 1 and names:
            rounds = self._grow(rows, borders, classes)
        return SoftmaxBoostedModel(borders, rounds, max(classes, 1))._set(featuresCol=self.getFeaturesCol())

    def _grow(self, rows: DataFrame, borders: list[np.ndarray], classes: int) -> list[Trees]:
        p, spark = self.settings, rows.sparkSession
        shared_folder(spark)
        packed = blocks(rows, by_value(_pack)(borders, classes), "boosting", even=True)
        data = packed.unpersist().mapPartitions(_joined).persist(StorageLevel.MEMORY_AND_DISK)
        tasks = data.getNumPartitions()
        widths, rounds = max(len(b) for b in borders) + 2, []
        for number in range(p["rounds"]):
            trees = Trees(classes, p["depth"])
            for level in range(p["depth"]):
                # Small sums go to the driver at once, others through a tree of tasks.
                size = 16 * classes * len(borders) * widths << level
                sums = total(data, histogram(trees, level, widths), 1 if size * tasks <= SMALL_BYTES else 2)
                if sums is None or not grow(trees, level, sums, level == p["depth"] - 1, p["rate"], p["smoothing"], p["least"]):
                    break
            rounds.append(trees)
            if number + 1 < p["rounds"]:
                before, data = data, data.map(_advance(trees)).persist(data.getStorageLevel())
                if (number + 1) % KEEP_EVERY == 0:
                    data.checkpoint()
                    data.count()
                    before.unpersist()
                elif number:
                    older.unpersist()
                older = before
        data.unpersist()
        return rounds


class SoftmaxBoostedModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, Saved):
    """Adds probability (an array) and prediction (the first of the likeliest classes)."""

    def __init__(self, borders: list[np.ndarray] | None = None, rounds: list[Trees] | None = None, classes: int = 1):
        super().__init__()
        self.borders, self.rounds, self.classes = borders or [], rounds or [], classes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        share = F.pandas_udf(by_value(_scorer)(self.borders, self.rounds, self.classes), "array<double>")
        column = self.getProbabilityCol()
        scored = dataset.withColumn(column, share(vector_to_array(self.getFeaturesCol())))
        best = F.array_position(column, F.array_max(column)) - 1
        return scored.withColumn(self.getPredictionCol(), best.cast("double"))

    def state(self) -> dict:
        trees = [{n: getattr(t, n).tolist() for n in ("feature", "border", "value")} for t in self.rounds]
        return {"borders": [b.tolist() for b in self.borders], "classes": self.classes, "rounds": trees}

    def with_state(self, state: dict) -> SoftmaxBoostedModel:
        self.borders, self.classes, self.rounds = [np.array(b) for b in state["borders"]], state["classes"], []
        for r in state["rounds"]:
            trees = Trees(self.classes, 0)
            trees.feature, trees.border, trees.value = np.array(r["feature"], np.int16), np.array(r["border"], np.uint8), np.array(r["value"])
            self.rounds.append(trees)
        return self


def _scorer(borders: list[np.ndarray], rounds: list[Trees], classes: int):
    def score(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=object)
        bins = binned(np.stack(features.to_list()).reshape(len(features), -1)[:, : len(borders)], borders)
        scores = np.zeros((len(bins), classes))
        for trees in rounds:
            scores = trees.add_to(scores, bins)
        return pd.Series(list(softmax(scores)))

    return score
