"""Fill-in-the-middle documents, cut at word boundaries held in a compressed set with rank selection."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.llm.kernels import chunks, words

# Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 42
#: Percent of the texts that are transformed, and percent of those that begin with the suffix.
RATE, SUFFIX_FIRST = 50, 80
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_SPAN = 1 << 16


class Sorted:
    """Container of few values: the values."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class Bits:
    """Container of many values: a bit for each of 65,536, with counts before each word of 64."""

    def __init__(self, low: np.ndarray):
        plain = np.zeros(_SPAN, bool)
        plain[low] = True
        self.words = np.packbits(plain, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words)))

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, "right")) - 1
        rest = int(self.words[word])
        for _ in range(rank - int(self.before[word])):
            rest &= rest - 1
        return word * 64 + (rest & -rest).bit_length() - 1


class Runs:
    """Container of stretches: their first values, with counts before each stretch."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.append(0, np.cumsum(lengths))

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, "right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container(low: np.ndarray) -> Sorted | Bits | Runs:
    """The smallest container of ascending values below 65,536: 2 bytes a value, 4 bytes a stretch or 8,192 bytes."""
    first = np.flatnonzero(np.append(True, np.diff(low) != 1))
    sizes = {Sorted: 2 * len(low), Runs: 4 * len(first), Bits: _SPAN // 8}
    kind = min(sizes, key=sizes.get)
    return Runs(low[first], np.diff(np.append(first, len(low)))) if kind is Runs else kind(low)


class BoundarySet:
    """Ascending distinct offsets in containers by their upper bits; `select` finds the container by counts, then the place in it."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        first = np.flatnonzero(np.append(True, np.diff(high) != 0)) if len(offsets) else np.zeros(0, np.int64)
        ends = np.append(first, len(offsets)).astype(np.int64)
        self.high = high[first]
        self.before = ends
        self.containers = [container(offsets[a:b] & (_SPAN - 1)) for a, b in zip(ends[:-1], ends[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The offset with so many smaller ones in the set."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, "right")) - 1
        return (int(self.high[at]) << 16) + self.containers[at].select(rank - int(self.before[at]))


def boundaries(ends: np.ndarray, size: int) -> np.ndarray:
    """0, the end of every word with the white space before it, and the end of white space after the last word."""
    tail = [size] if size and (not len(ends) or ends[-1] < size) else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def _characters(raw: np.ndarray) -> int:
    return int(((raw & 0xC0) != 0x80).sum())


def _transform(rate: int, suffix_first: int, seed: int, marks: tuple[str, str, str]):
    p, s, m = (x.encode() for x in marks)

    def one(doc_id: int | None, raw: np.ndarray, ends: np.ndarray) -> tuple:
        text, cuts = raw.tobytes(), boundaries(ends, len(raw))
        n = len(cuts) - 1
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not n or h3 % 100 >= rate or p in text or s in text or m in text:
            return doc_id, n, "plain", None, None, text
        found = BoundarySet(cuts)
        a, b = (found.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        form, output = ("spm", s + suffix + p + prefix + m + middle) if h4 % 100 < suffix_first else ("psm", p + prefix + s + suffix + m + middle)
        return doc_id, n, form, _characters(raw[:a]), _characters(raw[a:b]), output

    def run(batches):
        for rows, offsets, data in chunks(batches):
            _, ends, first = words(offsets, data)
            ids = rows.column("doc_id").to_pylist()
            made = [
                one(ids[i], data[offsets[i] : offsets[i + 1]], ends[first[i] : first[i + 1]] - offsets[i]) for i in range(rows.num_rows)
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
            output = pa.array([r[-1] for r in made], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, output], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def fill_in_middle(
    docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """Cut texts at two drawn word boundaries and put the middle last: doc_id, n, form, prefix_chars, middle_chars, output.

    A text has n units: words [^\\x20\\x09-\\x0D]+ with the white space before them, and white space at the end.  The n + 1 boundaries
    are kept in a `BoundarySet`; SHA-256 of seed and doc_id draws two of them (equal ones give an empty middle), so a document is cut
    alike wherever and however often it is computed.  `form` is psm (prefix, suffix, middle), spm (suffix first) or plain: the text as it
    is, for `100 - rate` percent of the documents, empty texts and texts that hold a mark.  Characters are code points, null where plain.

    Each row is done by itself, without a shuffle.  Null text counts as empty; texts of any length are cut whole, one at a time; a null doc_id
    draws as an empty one; repeated rows give equal rows; empty tables give no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_transform(rate, suffix_first, seed, marks), SCHEMA)


def restore(output: str | Column, form: str | Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that was transformed: exact, since transformed texts hold no mark."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(re.escape(m) for m in marks), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
