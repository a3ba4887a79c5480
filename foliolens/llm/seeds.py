"""Benchmark decontamination by spaced seeds over words."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.kernels import chunks, lower, mix, ranges, word_hashes, words
from foliolens.llm.store import fresh, stage

#: Words compared are marked 1, ignored ones 0.  Together these find every window of 8 to 20 words of which a fifth is replaced.
MASKS = ("1111", "11011")
WINDOW = 20
TOLERANCE = 0.2
#: So many words in a row that are all equal count in any item; at an edge of the document, windows may be cut off down to this.
RUN = 13
#: Shorter items say too little to be told from ordinary text.
SHORTEST = 8
#: Benchmark words in one block, which bounds what is broadcast at a time.
BLOCK_WORDS = 2_000_000
HITS = "array<struct<item_id:bigint,first:bigint,end:bigint>>"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FILTER = 1 << 20
#: Places of the benchmark laid against places of documents at a time.
_LAID = 1 << 20


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the compared words of the mask laid at each word."""
    size = len(tokens) - len(mask) + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(size, int(mask, 2), np.uint64)
    for i, kind in enumerate(mask):
        if kind == "1":
            total = total * _STEP + tokens[i : i + size]
    return mix(total)


class Items:
    """Benchmark items of one block: words, and for each mask the sorted seeds with the places where they start."""

    def __init__(self, ids: list[int], texts: list[str]):
        joined = [lower(np.frombuffer(t.encode(), np.uint8)) for t in texts]
        offsets = np.append(0, np.cumsum([len(t) for t in joined])).astype(np.int64)
        data = np.concatenate([*joined, np.zeros(0, np.uint8)])
        starts, ends, first = words(offsets, data)
        tokens = word_hashes(data, starts, ends)
        self.ids, self.tokens, self.first = [], [], []
        seeds = {m: ([], [], []) for m in MASKS}
        for item, a, b in zip(ids, first[:-1], first[1:]):
            if b - a < SHORTEST:
                continue
            for m, (hashes, owners, places) in seeds.items():
                found = seed_hashes(tokens[a:b], m)
                hashes.append(found)
                owners.append(np.full(len(found), len(self.ids)))
                places.append(np.arange(len(found)))
            self.ids.append(item)
            self.tokens.append(tokens[a:b])
        self.seeds = {}
        for m, parts in seeds.items():
            if parts[0]:
                hashes, owners, places = (np.concatenate(p) for p in parts)
                order = np.argsort(hashes, kind="stable")
                some = np.zeros(_FILTER, bool)
                some[(hashes % np.uint64(_FILTER)).astype(np.int64)] = True
                self.seeds[m] = hashes[order], owners[order], places[order], some

    def overlaps(self, tokens: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Row -> (item, first word, end word) of every verified overlap; `first` has the first word of each row and the end."""
        at, low, high, places_of = [], [], [], []
        for m, (hashes, _, _, some) in self.seeds.items():
            found = seed_hashes(tokens, m)
            maybe = np.flatnonzero(some[(found % np.uint64(_FILTER)).astype(np.int64)])
            maybe = maybe[maybe + len(m) <= first[np.searchsorted(first, maybe, "right")]]
            at.append(maybe)
            low.append(np.searchsorted(hashes, found[maybe], "left"))
            high.append(np.searchsorted(hashes, found[maybe], "right"))
            places_of.append(np.full(len(maybe), len(places_of)))
        spans: dict[int, set[tuple[int, int, int]]] = {}
        if at:
            at, low, high, kind = (np.concatenate(p) for p in (at, low, high, places_of))
            order = np.lexsort((kind, at))
            for part in np.split(order, self._steps((high - low)[order])):
                for row, item, begin in self._alignments(at[part], low[part], high[part], kind[part], first):
                    for a, b in self.verify(tokens, int(first[row]), int(first[row + 1]), int(item), int(begin)):
                        spans.setdefault(int(row), set()).add((int(item), a - int(first[row]), b - int(first[row])))
        return {row: [(self.ids[i], a, b) for i, a, b in sorted(found)] for row, found in spans.items()}

    @staticmethod
    def _steps(counts: np.ndarray) -> np.ndarray:
        """Where to cut places so that those between two cuts meet about _LAID places of items, however frequent a seed is."""
        return np.flatnonzero(np.diff(np.cumsum(counts) // _LAID)) + 1

    def _alignments(self, at, low, high, kind, first) -> np.ndarray:
        """Distinct (row, item, place of the item's first word) that the seeds at some places propose."""
        found = [np.zeros((0, 3), np.int64)]
        for k, (_, owners, places, _) in enumerate(self.seeds.values()):
            mine = kind == k
            count = (high - low)[mine]
            which, where = ranges(low[mine], count), np.repeat(at[mine], count)
            row = np.searchsorted(first, where, "right") - 1
            found.append(np.stack([row, owners[which], where - places[which]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def verify(self, tokens: np.ndarray, start: int, end: int, item: int, begin: int) -> list[tuple[int, int]]:
        """Maximal runs of words covered by windows that count, with the item's first word at `begin`."""
        words_ = self.tokens[item]
        length = min(WINDOW, len(words_))
        low, high = max(start, begin), min(end, begin + len(words_))
        size = high - low
        if size < min(length, RUN):
            return []
        same = np.append(0, np.cumsum(tokens[low:high] == words_[low - begin : high - begin]))
        change = np.zeros(size + 1, np.int64)
        for n, need in ((length, length - math.floor(TOLERANCE * length + 1e-9)), (RUN, RUN)):
            if n <= min(size, length):
                good = np.flatnonzero(same[n:] - same[:-n] >= need)
                change[good] += 1
                change[good + n] -= 1
        for n in range(RUN, min(length, size + 1)):
            need = max(RUN, n - math.floor(TOLERANCE * n + 1e-9))
            if begin < start and same[n] >= need:
                change[0] += 1
                change[n] -= 1
            if begin + len(words_) > end and same[size] - same[size - n] >= need:
                change[size - n] += 1
                change[size] -= 1
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]])))
        return [(low + int(a), low + int(b)) for a, b in zip(edges[::2], edges[1::2])]


def _search(block, names: list[str], column: str):
    def run(batches):
        items = Items(*block.value)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first", pa.int64()), ("end", pa.int64())]))
        for rows, offsets, data in chunks(batches):
            data = lower(data)
            starts, ends, first = words(offsets, data)
            found = items.overlaps(word_hashes(data, starts, ends), first)
            old = rows.column(column).to_pylist()
            hits = [
                [*have, *({"item_id": i, "first": a, "end": b} for i, a, b in found.get(row, []))] for row, have in enumerate(old)
            ]
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(hits, kind)], [*names, column])

    return run


def find_overlaps(docs: DataFrame, benchmark: DataFrame, column: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add the overlaps of each document with benchmark items: an array of (item_id, first word, end word).

    Words are maximal runs of [^\\x20\\x09-\\x0D], with A-Z lower-cased.  A document overlaps an item where, at one
    alignment, a window of min(20, words of the item) words has at most a fifth of its words replaced, or 13 words in a row are equal.
    Where an item goes on beyond the first or last word of the document, windows there may be cut off to 13 words or more, of which 13 and four fifths
    must be equal.  The fixed masks of the seeds ignore some positions, so that every such window has a hit; overlaps around hits
    are verified word by word.

    The benchmark is searched in blocks, one after the other: each is read and broadcast by itself, and dropped once its hits are written.
    Documents are never shuffled; with one block they are not written either.  Null and empty texts have no overlaps; texts of any
    length are searched whole; items of fewer than 8 words, null items and empty benchmarks match nothing;
    repeated items are each reported; repeated rows are each searched; other columns are kept.
    """
    spark, names = docs.sparkSession, docs.columns
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    size = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = math.ceil(size / block_words)
    out = docs.withColumn(column, F.expr(f"cast(array() as {HITS})"))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast(([r["item_id"] for r in part], [r["text"] for r in part]))
        out = out.mapInArrow(_search(sent, names, column), out.schema)
        if block < blocks - 1:
            out = stage(out, "searched")
            sent.destroy()
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any overlap with the benchmark, with their columns unchanged."""
    column = fresh(docs, "hits")
    return find_overlaps(docs, benchmark, column).filter(F.size(column) == 0).drop(column)
