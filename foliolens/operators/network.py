"""A classifier with one hidden layer over sparse text and dense layout.

Every word counts: words are hashed to rows of a weight table of fixed size (two rows each, so that few words share both), and no
vocabulary is built or cut.  Gradients are summed over all blocks of rows in a tree of tasks; what travels has the size of the
weights, whatever the number of rows or words.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.operators.blocked import ROWS_PER_BLOCK, Saved, blocks, by_bucket, total
from foliolens.plans.lineage import cut, shared_folder
from foliolens.plans.shipping import by_value

#: Entries of the word-by-row matrix that are worked on together: few enough for their products with the weights to stay in a core's cache.
PIECE = 4_000
#: Buckets that one row in so many has at least, and the most of them, are columns of a dense matrix: its products take less time than entries do.
OFTEN, COLUMNS = 256, 2048
WEIGHTS = ["words", "layout", "bias", "out", "out_bias"]


def buckets_of(words: str | Column, buckets: int) -> Column:
    """Two rows of the weight table for each word, in one array."""
    words = F.col(words) if isinstance(words, str) else words
    low = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    high = F.transform(words, lambda w: F.pmod(F.shiftright(F.xxhash64(w), 32), F.lit(buckets)).cast("int"))
    return F.coalesce(F.concat(low, high), F.array().cast("array<int>"))


def rows_of(ids: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, weight, first entry of each row and the end): counts times inverse document frequency, each row of length one."""
    buckets = len(idf)
    lengths = np.array([len(i) for i in ids], np.int64)
    flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    cells, counts = np.unique(np.repeat(np.arange(len(ids)), lengths) * buckets + flat, return_counts=True)
    row, bucket = cells // buckets, cells % buckets
    weight = counts * idf[bucket]
    norm = np.sqrt(np.bincount(row, weight * weight, len(ids)))
    first = np.searchsorted(row, np.arange(len(ids) + 1))
    return bucket.astype(np.int32), (weight / np.maximum(norm[row], 1e-12)).astype(np.float32), first


def pieces(first: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows with few entries each, a long row alone."""
    out, start = [], 0
    while start < len(first) - 1:
        end = max(start + 1, int(np.searchsorted(first, first[start] + PIECE, "right")) - 1)
        out.append((start, min(end, len(first) - 1)))
        start = out[-1][1]
    return out


class Words:
    """The word-by-row matrix of some rows: frequent buckets in dense columns, the others entry by entry."""

    def __init__(self, bucket: np.ndarray, weight: np.ndarray, first: np.ndarray, buckets: int):
        rows, self.buckets = len(first) - 1, buckets
        counts = np.bincount(bucket, minlength=buckets)
        often = np.flatnonzero(counts * OFTEN >= max(rows, 2 * OFTEN))
        self.often = often[np.argsort(-counts[often], kind="stable")[:COLUMNS]]
        column = np.full(buckets, -1, np.int32)
        column[self.often] = np.arange(len(self.often))
        row, at = np.repeat(np.arange(rows), np.diff(first)), column[bucket]
        frequent, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        self.dense = np.zeros((rows, len(self.often)), weight.dtype)
        self.dense[row[frequent], at[frequent]] = weight[frequent]
        self.bucket, self.weight, self.row = bucket[rest], weight[rest], row[rest]
        self.first = np.searchsorted(self.row, np.arange(rows + 1))

    def times(self, table: np.ndarray) -> np.ndarray:
        out = (self.dense @ table[self.often]).astype(np.float64)
        for a, b in pieces(self.first):
            entries, some = slice(self.first[a], self.first[b]), a + np.flatnonzero(np.diff(self.first[a : b + 1]))
            if len(some):
                out[some] += np.add.reduceat(table[self.bucket[entries]] * self.weight[entries, None], self.first[some] - self.first[a], axis=0)
        return out

    def transposed(self, rows: np.ndarray) -> np.ndarray:
        """The transposed matrix times some columns: a row for each bucket."""
        out = np.zeros((self.buckets, rows.shape[1]), rows.dtype)
        out[self.often] = self.dense.T @ rows
        order = by_bucket(self.bucket, self.buckets)
        ordered, of_row, weight = self.bucket[order], self.row[order], self.weight[order]
        starts = np.flatnonzero(np.append(True, np.diff(ordered) != 0)) if len(ordered) else np.zeros(0, np.int64)
        ends = np.append(starts, len(ordered))
        for a, b in pieces(ends):
            entries = slice(ends[a], ends[b])
            out[ordered[starts[a:b]]] = np.add.reduceat(rows[of_row[entries]] * weight[entries, None], starts[a:b] - starts[a], axis=0)
        return out


def hidden(weights: list[np.ndarray], words: Words, layout: np.ndarray) -> np.ndarray:
    """Inputs of the hidden units of some rows."""
    table, of_layout, bias = weights[:3]
    return words.times(table) + layout @ of_layout + bias


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def gradient(sent):
    """Sums over a block: loss and number of the rows learned from and of those held back, and the slopes of all weights by the former."""

    def of(block) -> list[np.ndarray]:
        weights = sent.value
        bucket, weight, first, layout, labels, held = block
        words, rows = Words(bucket, weight, first, len(weights[0])), np.arange(len(layout))
        inside = hidden(weights, words, layout)
        active = np.maximum(inside, 0)
        share = softmax(active @ weights[3] + weights[4])
        lost = -np.log(np.maximum(share[rows, labels], 1e-15))
        figures = np.array([lost[~held].sum(), (~held).sum(), lost[held].sum(), held.sum()], np.float64)
        share[rows, labels] -= 1
        share[held] = 0
        back = (share @ weights[3].T) * (inside > 0)
        slopes = [words.transposed(back.astype(weights[0].dtype)), layout.T @ back, back.sum(axis=0), active.T @ share, share.sum(axis=0)]
        return [figures, *(s.astype(w.dtype) for s, w in zip(slopes, weights))]

    return of


def _pack(idf: np.ndarray):
    def of(batch: pd.DataFrame):
        layout = np.stack(batch["x"].to_list()) if len(batch) else np.zeros((0, 0))
        return (*rows_of(batch["ids"].to_list(), idf), np.nan_to_num(layout), batch["y"].to_numpy(np.int64), batch["held"].to_numpy(bool))

    return of


class FusedNetwork(Estimator, HasLabelCol):
    """Trains on columns of words (an array of strings), layout (a scaled vector) and a class from 0.

    Full gradients with Adam steps over at most `rounds` passes, so the result depends on the rows and not on how they are laid out, up
    to rounding.  One row in `hold` by hash is held back: the weights of the pass with the least loss on those are kept, and training ends
    `patience` passes after it.  Rows with a null label are left out; null words count as none; a row of any length is one row of the matrix.
    """

    @keyword_only
    def __init__(self, *, wordsCol: str = "words", layoutCol: str = "layout", labelCol: str = "class", classes: int | None = None,
                 buckets: int = 1 << 14, units: int = 64, rounds: int = 100, rate: float = 0.01, decay: float = 1e-2, hold: int = 10,
                 patience: int = 10, seed: int = 42):
        super().__init__()
        defaults = {"wordsCol": "words", "layoutCol": "layout", "classes": None, "buckets": 1 << 14, "units": 64, "rounds": 100,
                    "rate": 0.01, "decay": 1e-2, "hold": 10, "patience": 10, "seed": 42}
        self.settings = defaults | {k: v for k, v in self._input_kwargs.items() if k != "labelCol"}
        self._set(labelCol=labelCol)
        self.losses: list[tuple[float, float]] = []  # of each pass: on rows learned from, on rows held back

    def _fit(self, dataset: DataFrame) -> FusedNetworkModel:
        for function in (blocks, cut):
            by_value(function)
        p, spark = self.settings, dataset.sparkSession
        shared_folder(spark)
        ids = buckets_of(p["wordsCol"], p["buckets"])
        rows = cut(
            dataset.select(ids.alias("ids"), vector_to_array(p["layoutCol"]).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y")).where("y is not null")
            .withColumn("held", F.pmod(F.xxhash64("ids", "x"), F.lit(p["hold"])) == 0)
        )
        known = rows.agg(F.count(F.lit(1)), F.max("y"), F.max(F.size("x"))).first()
        classes, inputs = p["classes"] or (known[1] or 0) + 1, known[2] or 0
        # One count per bucket at most.
        idf = np.full(p["buckets"], np.log(1 + known[0]) + 1)
        for r in rows.select(F.explode(F.array_distinct("ids")).alias("id")).groupBy("id").count().collect():
            idf[r["id"]] = np.log((1 + known[0]) / (1 + r["count"])) + 1
        random = np.random.default_rng(p["seed"])
        scale = lambda n: np.sqrt(2 / max(n, 1))
        weights = [
            random.normal(0, 0.1, (p["buckets"], p["units"])), random.normal(0, scale(inputs), (inputs, p["units"])), np.zeros(p["units"]),
            random.normal(0, scale(p["units"]), (p["units"], classes)), np.zeros(classes),
        ]
        data = blocks(rows, by_value(_pack)(idf), "network", even=True)
        best, self.losses = None, []
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, p["rounds"] + 1):
            sent = spark.sparkContext.broadcast([w.astype(np.float32) for w in weights])
            sums = total(data, gradient(sent))
            sent.destroy()
            if sums is None:
                break
            (loss, n, other, m), slopes = sums[0], sums[1:]
            self.losses.append((float(loss / max(n, 1)), float(other / m if m else loss / max(n, 1))))
            if best is None or self.losses[-1][1] < best[0]:
                best = self.losses[-1][1], step, [w.copy() for w in weights]
            elif step - best[1] >= p["patience"]:
                break
            for i, slope in enumerate(slopes):
                slope = slope / max(n, 1)
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                move = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                weights[i] = weights[i] * (1 - p["decay"]) - p["rate"] * move
        data.unpersist()
        return FusedNetworkModel(idf, best[2] if best else weights, p["wordsCol"], p["layoutCol"])


class FusedNetworkModel(Model, HasPredictionCol, HasProbabilityCol, Saved):
    """Adds probability (an array) and prediction (the first of the likeliest classes)."""

    def __init__(self, idf: np.ndarray | None = None, weights: list[np.ndarray] | None = None, words: str = "words", layout: str = "layout"):
        super().__init__()
        self.idf, self.weights, self.words, self.layout = idf, weights, words, layout

    def _transform(self, dataset: DataFrame) -> DataFrame:
        share = F.pandas_udf(by_value(_scorer)(self.idf, [w.astype(np.float32) for w in self.weights]), "array<double>")
        column = self.getProbabilityCol()
        scored = dataset.withColumn(column, share(buckets_of(self.words, len(self.idf)), vector_to_array(self.layout)))
        return scored.withColumn(self.getPredictionCol(), (F.array_position(column, F.array_max(column)) - 1).cast("double"))

    def state(self) -> dict:
        arrays = {n: {"shape": w.shape, "data": base64.b64encode(w.astype(np.float32).tobytes()).decode()} for n, w in zip(WEIGHTS, self.weights)}
        return arrays | {"idf": base64.b64encode(self.idf.tobytes()).decode(), "columns": [self.words, self.layout]}

    def with_state(self, state: dict) -> FusedNetworkModel:
        read = lambda text, kind: np.frombuffer(base64.b64decode(text), kind)
        self.weights = [read(state[n]["data"], np.float32).reshape(state[n]["shape"]) for n in WEIGHTS]
        self.idf = read(state["idf"], np.float64)
        self.words, self.layout = state["columns"]
        return self


def _scorer(idf: np.ndarray, weights: list[np.ndarray]):
    def score(ids: pd.Series, layout: pd.Series) -> pd.Series:
        if not len(ids):
            return pd.Series([], dtype=object)
        bucket, weight, first = rows_of(ids.to_list(), idf)
        x, out = np.nan_to_num(np.stack(layout.to_list())), []
        for a in range(0, len(x), ROWS_PER_BLOCK):
            begin = first[a : a + ROWS_PER_BLOCK + 1]
            words = Words(bucket[begin[0] : begin[-1]], weight[begin[0] : begin[-1]], begin - begin[0], len(idf))
            out.append(softmax(np.maximum(hidden(weights, words, x[a : a + ROWS_PER_BLOCK]), 0) @ weights[3] + weights[4]))
        return pd.Series(list(np.concatenate(out).astype(np.float64)))

    return score
