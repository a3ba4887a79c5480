"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliolens.llm.kernels import chunks, lower
from foliolens.llm.store import extended, fresh

BUCKETS = 1 << 13
#: Texts whose counts by bucket are held at a time.
ROWS = 128
#: Documents in the training sample, shared evenly by the languages.
SAMPLE = 2000
#: A decision is ambiguous where the second codeword's loss is within this share of the first's.
MARGIN = 0.1
UNKNOWN = "und"


def codewords(classes: int) -> np.ndarray:
    """A row of -1 / +1 bits per class: all splits of few classes, else the best spread of some random codes."""
    if classes <= 2:
        return np.array([[1.0], [-1.0]])[:classes]
    if classes <= 6:
        splits = [s for s in itertools.product((-1.0, 1.0), repeat=classes - 1) if min(s) < 0]
        return np.array([[1.0] * len(splits), *zip(*splits)])
    best, spread = None, -1
    random = np.random.default_rng(7)
    for _ in range(200):
        code = random.choice([-1.0, 1.0], (classes, math.ceil(10 * math.log2(classes))))
        near = (code @ code.T - np.eye(classes) * 1e9).max()
        if best is None or -near > spread:
            best, spread = code, -near
    return best


def features(offsets: np.ndarray, data: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """A row per text: square roots of the counts of byte 1- to 3-grams by bucket, scaled to length one."""
    rows = len(offsets) - 1
    data = lower(data).astype(np.int64)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.zeros(rows * buckets)
    for n in (1, 2, 3):
        size = len(data) - n + 1
        if size <= 0:
            break
        gram = np.full(size, n, np.int64)
        for i in range(n):
            gram = (gram << 8) | data[i : i + size]
        key = ((gram * 0x9E3779B1) >> 9) % buckets
        whole = row[:size] == row[n - 1 :]
        counts += np.bincount((row[:size] * buckets + key)[whole], minlength=rows * buckets)
    x = np.sqrt(counts.reshape(rows, buckets)).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def train(x: np.ndarray, classes: np.ndarray, code: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights per bit (the last row is the bias) and the weight of each bit's loss for each class.

    Full gradients with momentum; each class counts the same.  A bit weighs as much in a class as its share of right decisions there.
    """
    y = code[classes].astype(np.float32)
    share = (1 / np.bincount(classes, minlength=len(code)).clip(1))[classes].astype(np.float32)[:, None]
    share /= share.sum()
    w = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)
    speed = np.zeros_like(w)
    for _ in range(rounds):
        slope = share * -y / (1 + np.exp(np.clip(y * (x @ w[:-1] + w[-1]), -30, 30)))
        speed = 0.9 * speed - 2.0 * (np.vstack([x.T @ slope, slope.sum(axis=0)]) + 1e-6 * w)
        w += speed
    right = (x @ w[:-1] + w[-1]) * y > 0
    trust = np.array([right[classes == k].mean(axis=0) if (classes == k).any() else np.ones(code.shape[1]) for k in range(len(code))])
    return w, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)


def decode(margins: np.ndarray, code: np.ndarray, trust: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of the codeword with the least weighted loss, its probability-like score, and whether the second is near."""
    loss = np.stack([(np.logaddexp(0, -margins * code[k]) * trust[k]).sum(axis=1) for k in range(len(code))], axis=1)
    best = loss.argmin(axis=1)
    least = loss[np.arange(len(loss)), best]
    likely = np.exp(-4 * (loss - least[:, None]))
    score = 1 / likely.sum(axis=1)
    second = np.partition(loss, 1, axis=1)[:, 1] if len(code) > 1 else least + 1e9
    return best, score, second - least < MARGIN * least


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept for measuring: never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _featurise(batches):
    for rows, offsets, data in chunks(batches, most=ROWS):
        x = features(offsets, data).astype(np.float16)
        some = [np.flatnonzero(r).astype(np.uint16) for r in x]  # most buckets of a text are empty
        packed = [at.tobytes() + r[at].tobytes() for at, r in zip(some, x)]
        yield pa.RecordBatch.from_arrays([rows.column("lang"), pa.array(packed, pa.binary())], ["lang", "x"])


def _unpacked(rows: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    x = np.zeros((len(rows), buckets), np.float32)
    for row, packed in zip(x, rows):
        half = len(packed) // 2
        row[np.frombuffer(packed[:half], np.uint16)] = np.frombuffer(packed[half:], np.float16)
    return x


def fit(docs: DataFrame, sample: int = SAMPLE):
    """Learn languages, codewords and classifiers from a bounded sample of the rows that are not held out.

    The same number of documents is taken for each language, those of the smallest hash of doc_id, so the sample does not depend on
    the layout.  The number of a language's rows bounds the hashes that can be among them, so no more than about twice as many are ordered,
    however many rows the language has.  Beyond `sample` languages those with the most rows are learned (ties: the first by name).
    Of rows with equal doc_id and language the smallest text counts; rows without doc_id or language are not learned from.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
    known = known.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return [], None
    each = max(1, sample // len(languages))
    highest = [(r["lang"], min((1 << 63) - 1, -(1 << 63) + (2 * each + 64 << 64) // r["n"])) for r in counts]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(highest, "lang string, _highest long"))  # at most `sample` rows
    small = known.withColumn("_hash", F.xxhash64("doc_id")).join(bounds, "lang").filter("_hash <= _highest")
    order = W.partitionBy("lang").orderBy("_hash", "doc_id")
    chosen = small.select("lang", "doc_id", "_hash").distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each)
    ids = F.broadcast(chosen.select("doc_id", "lang"))  # at most `sample` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").join(ids, ["doc_id", "lang"])
    texts = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    rows = sorted((r["lang"], bytes(r["x"])) for r in texts.select("lang", "text").mapInArrow(_featurise, "lang string, x binary").collect())
    code = codewords(len(languages))
    w, trust = train(_unpacked([x for _, x in rows]), np.array([languages.index(lang) for lang, _ in rows]), code)
    return languages, (w, code, trust)


def _predict(model, names: list[str], added: list[str]):
    def run(batches):
        languages, parts = model.value
        for rows, offsets, data in chunks(batches, most=ROWS):
            lettered = [t is not None and any(map(str.isalpha, t)) for t in rows.column("text").to_pylist()]
            n = len(lettered)
            lang, score, unsure = np.full(n, None, object), np.zeros(n), np.ones(n, bool)
            if parts is not None and n:
                w, code, trust = parts
                best, score, unsure = decode(features(offsets, data) @ w[:-1] + w[-1], code, trust)
                lang = np.array(languages, object)[best]
            lang = [x if ok and x is not None else UNKNOWN for x, ok in zip(lang, lettered)]
            known = np.array([x != UNKNOWN for x in lang], bool)
            extra = [pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64()), pa.array(unsure | ~known)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *extra], [*names, *added])

    return run


def identify(docs: DataFrame, model, added: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """Add the predicted language, a score from 0 to 1, and whether another language is nearly as near.

    Each bit of a language's codeword is predicted by a linear classifier over byte 1- to 3-grams; decoding takes the codeword
    of the least loss, with losses weighted by how far each bit can be trusted for each language.  Only `text` is read.
    Texts that are null or have no letter get `und`, score 0, ambiguous; so does every text where there was nothing to learn from.
    Of equally near languages the first by name is taken, flagged ambiguous.  Whole texts are read, of any length.
    Rows keep their columns and number; repeated rows are each judged; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = extended(docs, **dict(zip(added, ("string", "double", "boolean"))))
    return docs.mapInArrow(_predict(sent, docs.columns, list(added)), schema)


def known_language(docs: DataFrame, training: DataFrame) -> DataFrame:
    """The documents whose language can be told, unchanged: those with `und` go.

    An ambiguous text in some language is still text, so it stays.
    """
    added = [fresh(docs, n) for n in ("lang_pred", "score", "ambiguous")]
    return identify(docs, fit(training), tuple(added)).filter(F.col(added[0]) != UNKNOWN).drop(*added)
