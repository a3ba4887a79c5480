"""Quality scores by naive Bayes support vectors over hashed n-gram indicators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.kernels import chunks, distinct, gram_hashes, lower, word_hashes, words
from foliolens.llm.language import held_out
from foliolens.llm.store import extended

WORD_BUCKETS = 1 << 16
BYTE_BUCKETS = 1 << 13
SHAPE_BUCKETS = 1 << 12
BUCKETS = WORD_BUCKETS + BYTE_BUCKETS + SHAPE_BUCKETS
#: Labelled documents in the training sample: those of the smallest hash of doc_id.
SAMPLE = 8000
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 20
#: Share of the naive Bayes direction's mean weight that is mixed into the fitted weights.
MIXED = 0.1
THRESHOLD = 0.7
#: Texts whose features are held at a time.
ROWS = 512


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A small code per word: cases, digits and other signs in it, its last sign, its length class, and whether it repeats the word before."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    def inside(kind: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(kind))
        return total[ends] - total[starts]

    length = ends - starts
    upper = inside((data >= 65) & (data <= 90))
    small = inside(((data >= 97) & (data <= 122)) | (data >= 128))
    digit = inside((data >= 48) & (data <= 57))
    other = length - upper - small - digit
    code = np.minimum(upper, 2) + 3 * (small > 0) + 6 * (digit > 0) + 12 * np.minimum(other, 3)
    code = code * 5 + np.digitize(length, [2, 5, 10, 20])
    last = data[ends - 1].astype(np.int64)
    code = code * 128 + np.where(((last >= 33) & (last < 48)) | ((last >= 58) & (last < 65)) | ((last >= 91) & (last < 97)) | ((last > 122) & (last < 127)), last, 0)
    again = np.append(False, tokens[1:] == tokens[:-1])
    return (code * 2 + again).astype(np.uint64)


def indicators(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text as (row, bucket), rows ascending: words and pairs, byte 3-grams, and 1- to 3-grams of word shapes."""
    rows = len(offsets) - 1
    small = lower(data)
    starts, ends, first = words(offsets, small)
    tokens = word_hashes(small, starts, ends)
    forms = shapes(data, starts, ends, tokens)
    owner = np.repeat(np.arange(rows), np.diff(first))
    keys = []
    for n in (1, 2):
        grams = gram_hashes(tokens, n)
        whole = owner[: len(grams)] == owner[n - 1 :]
        key = owner[: len(grams)] * BUCKETS + (grams % np.uint64(WORD_BUCKETS)).astype(np.int64)
        keys.append(key[whole])
    keys = [distinct(np.concatenate(keys))]
    seen = np.zeros((rows, BYTE_BUCKETS + SHAPE_BUCKETS), bool)
    byte = np.repeat(np.arange(rows), np.diff(offsets))
    if len(data) >= 3:
        wide = data.astype(np.int64)
        gram = ((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * 0x9E3779B1 >> 9) % BYTE_BUCKETS
        whole = byte[:-2] == byte[2:]
        seen[byte[:-2][whole], gram[whole]] = True
    for n in (1, 2, 3):
        grams = gram_hashes(forms, n)
        whole = owner[: len(grams)] == owner[n - 1 :]
        seen[owner[: len(grams)][whole], BYTE_BUCKETS + (grams[whole] % np.uint64(SHAPE_BUCKETS)).astype(np.int64)] = True
    row, bucket = np.nonzero(seen)
    keys.append(row * BUCKETS + WORD_BUCKETS + bucket)
    key = np.sort(np.concatenate(keys))
    return key // BUCKETS, key % BUCKETS


def log_count_ratio(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of the smoothed ratio of each feature's share in both classes."""
    counts = np.full((2, BUCKETS), SMOOTHING)
    for bucket, y in zip(rows, good):
        counts[int(y), bucket] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0]).astype(np.float32)


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """Linear hinge-loss weights (the last is the bias): each step solves one example's dual variable exactly.

    The classes count the same: the rarer one has the higher upper bound.
    """
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1 for v in values])
    bound = np.where(y > 0, COST * len(y) / max(1, 2 * (y > 0).sum()), COST * len(y) / max(1, 2 * (y < 0).sum()))
    random = np.random.default_rng(3)
    for _ in range(rounds):
        most = 0.0
        for i in random.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), bound[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                most = max(most, abs(new - alpha[i]))
                w[rows[i]] += step * values[i]
                w[-1] += step
                alpha[i] = new
        if most < 1e-3:
            break
    return w


def calibrate(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to the chance of label 1, by Newton steps."""
    a, b = 1.0, 0.0
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, h = p - target, p * (1 - p) + 1e-9
        grad = np.array([(d * margins).sum(), d.sum()])
        curve = np.array([[(h * margins * margins).sum(), (h * margins).sum()], [(h * margins).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """Learn from a bounded sample of labelled rows that are not held out; None where one of the classes is missing."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    found = texts.mapInArrow(_featurise, "doc_id long, quality int, x binary").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    rows = [np.frombuffer(r["x"], np.int32) for r in found]
    good = np.array([r["quality"] == 1 for r in found], bool)
    if not good.any() or good.all():
        return None
    check = np.arange(len(rows)) % 5 == 4  # used for the curve only
    learn = [i for i in range(len(rows)) if not check[i]]
    if len(set(good[learn])) < 2:
        learn, check = list(range(len(rows))), np.ones(len(rows), bool)
    ratio = log_count_ratio([rows[i] for i in learn], good[learn])
    scaled = [ratio[r] / max(1e-9, float(np.sqrt(ratio[r] @ ratio[r]))) if len(r) else np.zeros(0, np.float32) for r in rows]
    w = dual_coordinate_descent([rows[i] for i in learn], [scaled[i] for i in learn], np.where(good[learn], 1.0, -1.0), BUCKETS)
    w[:-1] = (1 - MIXED) * w[:-1] + MIXED * np.abs(w[:-1]).mean()
    margins = np.array([w[rows[i]] @ scaled[i] + w[-1] for i in np.flatnonzero(check)])
    return ratio, w[:-1] * ratio, float(w[-1]), *calibrate(margins, good[check])


def _featurise(batches):
    for rows, offsets, data in chunks(batches, most=ROWS):
        row, bucket = indicators(offsets, data)
        cut = np.searchsorted(row, np.arange(rows.num_rows + 1))
        x = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("quality"), pa.array(x, pa.binary())], ["doc_id", "quality", "x"])


def _score(model, names: list[str], added: str):
    def run(batches):
        for rows, offsets, data in chunks(batches, most=ROWS):
            score = np.full(rows.num_rows, 0.5)
            if model.value is not None and rows.num_rows:
                ratio, w, shift, a, b = model.value
                row, bucket = indicators(offsets, data)
                norm = np.sqrt(np.bincount(row, ratio[bucket].astype(float) ** 2, rows.num_rows))
                margin = np.bincount(row, w[bucket], rows.num_rows) / np.maximum(norm, 1e-9) + shift
                score = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(score, pa.float64())], [*names, added])

    return run


def score_quality(docs: DataFrame, model, added: str = "score") -> DataFrame:
    """Add the chance, 0 to 1, that a text has quality label 1.

    Indicators of word, byte and word-shape n-grams are scaled by their log-count ratio between the classes; a linear hinge-loss
    model over them, fitted by dual coordinate descent, gives a margin, and a logistic curve fitted on rows it has not seen gives the score.
    Only `text` is read, as a whole.  Null texts count as empty, and have the score of a text without features (0.5 where
    nothing was learned).  Rows keep their columns and number; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score(sent, docs.columns, added), extended(docs, **{added: "double"}))
