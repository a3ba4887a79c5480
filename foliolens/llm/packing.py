"""Packing of token sequences by cutting-stock column generation."""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliolens.llm.store import ranked

CAPACITY = 1024
END = 0
#: Lengths are rounded up to multiples of this for the plan, so the program stays small; real lengths fill the sequences.
GRID = 4
#: The linear program stops when it is proven this near to its optimum, or after so many columns.
GAP = 0.002
ROUNDS = 4000
SMOOTH = 0.8
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=1)
def _encoder(vocabulary: str | None):
    """Function from text to ids of the 50k byte-level vocabulary.

    The rank file holds the same merges as the JSON file and is read by a faster library.  Texts with the
    literal end mark, and any that this library refuses, go through the JSON tokenizer itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    slow = lru_cache(maxsize=1)(lambda: Tokenizer.from_file(path))  # large, and seldom needed
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str):
        if "<|endoftext|>" not in text:
            try:
                return fast.encode_ordinary(text)
            except Exception:  # its regular expressions give up on some very long runs
                pass
        return slow().encode(text, add_special_tokens=False).ids

    return encode


def _pieces(ids: np.ndarray, capacity: int):
    """Full pieces, then half a piece if the rest is longer: what is left is short, so patterns fill up."""
    start = 0
    while start < len(ids):
        left = len(ids) - start
        size = capacity if left >= capacity else capacity // 2 if left > capacity // 2 else left
        yield start, ids[start : start + size]
        start += size


def _cut(vocabulary: str | None, capacity: int):
    def run(batches):
        encode = _encoder(vocabulary)
        for batch in batches:
            rows = ([], [], [], [], [])
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END], "<u4")
                for start, piece in _pieces(ids, capacity):
                    for out, value in zip(rows, (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))):
                        out.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names)

    return run


def _price(duals: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable pattern: unbounded knapsack by dynamic programming over the capacity."""
    longest = int(lengths[-1])
    worth = np.full(longest, -1.0)  # worth[i]: value of length longest - i, so that it lines up with best[c - longest : c]
    worth[longest - lengths] = duals
    best, last = np.zeros(longest + capacity + 1), np.zeros(capacity + 1, np.int64)
    best[:longest] = -1e9
    for c in range(1, capacity + 1):
        total = best[c : c + longest] + worth
        i = int(total.argmax())
        if total[i] > best[longest + c - 1] + 1e-12:
            best[longest + c], last[c] = total[i], longest - i
        else:
            best[longest + c] = best[longest + c - 1]
    pattern, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if last[c]:
            pattern[np.searchsorted(lengths, last[c])] += 1
            c -= last[c]
        else:
            c -= 1
    return float(best[-1]), pattern


def column_generation(
    lengths: np.ndarray, demand: np.ndarray, capacity: int = CAPACITY, gap: float = GAP, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional use: revised simplex over the patterns found worth adding.

    Starts from one pattern per length.  Each round prices all patterns with the current duals; the best enters and
    the ratio test picks the one that leaves.  Ends at the optimum or when the dual bound proves the gap.
    """
    bound = float(lengths @ demand) / capacity
    best = lengths / capacity  # prices by length alone: their bound is the total length
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ demand
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        # Prices near the best ones so far give full patterns; where those do not pay, the current prices do.
        near = SMOOTH * best + (1 - SMOOTH) * duals
        value, pattern = _price(near, lengths, capacity)
        if float(near @ demand) / value > bound:
            bound, best = float(near @ demand) / value, near / value
        if duals @ pattern <= 1 + 1e-9:
            value, pattern = _price(duals, lengths, capacity)
            if value <= 1 + 1e-9:
                break
        if use.sum() * (1 - gap) <= bound:
            break
        step = inverse @ pattern
        rows = np.flatnonzero(step > 1e-9)
        leave = rows[(use[rows] / step[rows]).argmin()]
        amount = use[leave] / step[leave]
        use -= amount * step
        use[leave] = amount
        np.clip(use, 0, None, out=use)
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        basis[:, leave] = pattern
    return basis, use


def _fill(left: list[list[int]], capacity: int) -> list[dict[int, int]]:
    """Best fit, longest first, of the few items that rounding leaves; one pattern per sequence."""
    open_: list[list] = []  # [room, {length: count}]
    by_room: dict[int, list[dict[int, int]]] = {}
    for length, count in sorted(left, reverse=True):
        for _ in range(count):
            room = next((r for r in range(length, capacity + 1) if by_room.get(r)), None)
            pattern = by_room[room].pop() if room else {}
            if not room:
                open_.append(pattern)
            pattern[length] = pattern.get(length, 0) + 1
            by_room.setdefault((room or capacity) - length, []).append(pattern)
    return open_


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Which ranks of each length class go where: (length, first rank, end rank, per sequence, first sequence, first slot).

    `histogram` has at most `capacity` lengths, whatever the number of documents.
    """
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], float)
    if not len(lengths):
        return []
    columns, use = column_generation(lengths, demand, capacity)
    left, patterns = {int(x): histogram[int(x)] for x in lengths}, []
    for j in np.argsort(-use, kind="stable"):
        parts = {int(lengths[i]): int(round(columns[i, j])) for i in np.flatnonzero(columns[:, j] > 0.5)}
        count = min([int(use[j] + 1e-6), *(left[x] // k for x, k in parts.items())])
        if count:
            patterns.append((parts, count))
            for x, k in parts.items():
                left[x] -= k * count
    patterns += [(p, 1) for p in _fill([[x, k] for x, k in left.items() if k], capacity)]
    rows, taken, sequence = [], dict.fromkeys(left, 0), 0
    for parts, count in patterns:
        slot = 0
        for length in sorted(parts, reverse=True):
            k, first = parts[length], taken[length]
            rows.append((length, first, first + k * count, k, sequence, slot))
            taken[length] += k * count
            slot += k
        sequence += count
    return rows


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, grid: int = GRID) -> DataFrame:
    """Pack documents into sequences of at most `capacity` tokens (a multiple of `grid`).

    A document's ids, with an end id, are cut into full pieces, a half piece where more than half is left, and a rest.  The
    histogram of piece lengths (in classes of `grid` tokens, so at most capacity / grid numbers) is a cutting-stock problem,
    solved on the driver by column generation.  Rounded patterns say how many pieces of each class share a
    sequence; pieces take the places of their class in the order of their rank by doc_id.  What rounding leaves (fewer
    sequences than patterns) is packed by best fit.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  Null and empty texts are one
    piece with the end id.  Repeated rows are packed each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(vocabulary, capacity), PIECES)
    kind = F.ceil(F.col("length") / grid).cast("long").alias("_class")
    pieces, _ = ranked(rows.select("*", kind), ["_class", "doc_id", "start"], "pieces")
    counted = pieces.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first")).collect()
    plan = plan_patterns({r["_class"]: r["n"] for r in counted}, capacity // grid)
    begin = {r["_class"]: r["first"] for r in counted}
    # A few rows for each pattern, and no more patterns than classes plus what rounding leaves: small enough to broadcast.
    table = docs.sparkSession.createDataFrame(
        [(x, begin[x] + a, begin[x] + b, k, s, o) for x, a, b, k, s, o in plan],
        "_class long, _first long, _end long, _each long, _sequence long, _slot long",
    )
    at = F.col("rank") - F.col("_first")
    placed = (
        pieces.join(F.broadcast(table), "_class")
        .filter("rank >= _first and rank < _end")
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
            (F.col("_slot") + at % F.col("_each")).alias("_slot"),
        )
    )
    earlier = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")).drop("_slot")
