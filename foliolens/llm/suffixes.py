"""Suffix-array dedup: sorted, front-coded runs of suffixes, exchanged and merged with loser trees that know common prefixes."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.jaccard import _table
from foliolens.llm.kernels import pack, prefix_hash, span_hash, unpack
from foliolens.llm.repeats import anchors, candidates, expand, read_places, union_spans
from foliolens.llm.store import targets

WINDOW = 400
GRAM = 128
#: Suffix bytes that one task holds before it sends a run.
HELD = 24 << 20
#: What a window of a hot anchor counts for in it.
WINDOW_COST = 128
KEY = 8
#: Suffixes whose windows are compared at once, in whole groups.
AT_ONCE = 4096
EMPTY = hashlib.sha256(b"").digest()


def measure(offsets: np.ndarray, data: np.ndarray):
    raw, edges = data.tobytes(), offsets.tolist()
    digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(edges[:-1], edges[1:])]
    start = np.arange(max(0, len(data) - GRAM + 1))
    grams = span_hash(prefix_hash(data), start, start + GRAM)
    return np.diff(offsets).tolist(), digests, digests, anchors(grams, GRAM, offsets, WINDOW)


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes need no comparison."""
    n = min(len(x), len(y))
    a, b = x[known:n], y[known:n]
    if a == b:
        return n
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs of (string, common prefix with the one before) and gives the same pairs in order.

    Each loser keeps its common prefix with the string that beat it.  In a later match the one with the longer prefix with the last
    winner is the smaller; only equal prefixes are compared further, from their end on: no byte is compared twice.
    """

    def __init__(self, runs: list):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.at = [0] * len(runs)
        self.lost = [(-1, 0)] * self.size  # (run, common prefix with the winner of the match)

    def _head(self, run: int):
        return self.runs[run][0][self.at[run]] if 0 <= run < len(self.runs) and self.at[run] < len(self.runs[run][0]) else None

    def _match(self, a: tuple[int, int], b: tuple[int, int]):
        """(winner, loser) of two heads with their prefixes with the last winner; ended runs lose, equal strings go by run."""
        x, y = self._head(a[0]), self._head(b[0])
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)
        n = common_prefix(x, y, a[1])
        first = n == len(x) if n == len(x) or n == len(y) else x[n] < y[n]
        if len(x) == len(y) == n:
            first = a[0] < b[0]
        return (a, (b[0], n)) if first else (b, (a[0], n))

    def _build(self, node: int) -> tuple[int, int]:
        if node >= self.size:
            run = node - self.size
            return (run if run < len(self.runs) else -1, 0)
        winner, self.lost[node] = self._match(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self):
        """(run, place in the run, common prefix with the string given before)."""
        winner = self._build(1)
        while self._head(winner[0]) is not None:
            run, prefix = winner
            yield run, self.at[run], prefix
            self.at[run] += 1
            prefixes = self.runs[run][1]
            winner = (run, prefixes[self.at[run]] if self.at[run] < len(prefixes) else 0)
            node = (self.size + run) // 2
            while node:
                winner, self.lost[node] = self._match(winner, self.lost[node])
                node //= 2


def neighbours(strings: list[bytes]) -> np.ndarray:
    """Common prefix of each sorted string with the one before (0 for the first)."""
    return np.array([0, *(common_prefix(a, b) for a, b in zip(strings, strings[1:]))][: len(strings)], np.int64)


def front_code(strings: list[bytes], prefixes: np.ndarray, lefts: list[bytes], *numbers: np.ndarray) -> bytes:
    """A sorted run without what each string shares with the one before."""
    tails = [s[p:] for s, p in zip(strings, prefixes.tolist())]
    columns = [prefixes.astype(np.int64), np.array([len(t) for t in tails], np.int64), np.array([len(x) for x in lefts], np.int64), *numbers]
    table = np.array(columns, np.int64)
    head = np.array(table.shape, np.int64).tobytes()
    planes = np.ascontiguousarray(table).view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1).tobytes()
    return head + zlib.compress(planes + b"".join(tails) + b"".join(lefts), 3)


def decode(blob: bytes) -> tuple[list[bytes], list[int], list[bytes], np.ndarray]:
    """(strings, common prefixes, left contexts, further numbers) of a run."""
    k, n = np.frombuffer(blob[:16], np.int64)
    raw = zlib.decompress(blob[16:])
    cut = int(k * n * 8)
    planes = np.frombuffer(raw[:cut], np.uint8).reshape(k, 8, n).transpose(0, 2, 1)
    table = np.ascontiguousarray(planes).view(np.int64).reshape(k, n)
    strings, lefts, last, at = [], [], b"", cut
    for p, size in zip(table[0].tolist(), table[1].tolist()):
        last = last[:p] + raw[at : at + size]
        at += size
        strings.append(last)
    for size in table[2].tolist():
        lefts.append(raw[at : at + size])
        at += size
    return strings, table[0].tolist(), lefts, table[3:]


RUNS = "target int, blob binary, windows binary, doc_id long, first long, last long"
_RUNS = pa.schema([
    ("target", pa.int32()), ("blob", pa.binary()), ("windows", pa.binary()), ("doc_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
])
_WINDOWS = (np.uint64, np.int64, np.uint8, np.uint64, np.uint64)


def _runs(pieces: int):
    """Sorted runs of the suffixes at the places that occur again, dealt by the hash in front of each.

    Equal suffixes with equal windows that meet in one task are settled there; one of them goes on for the others' sake.
    Around a hot anchor each window goes by its own digest, once per task, and those met before are settled.
    """

    def run(batches):
        held: dict[tuple, tuple[int, int]] = {}
        settled: set[tuple] = set()
        whole: dict[tuple, tuple[int, int]] = {}
        windows: dict[bytes, list[int]] = {}  # document, start, whether it occurs again in the task
        size = 0

        def send():
            rows, dealt = [], {}
            for (suffix, left, least, most), (doc, at) in held.items():
                dealt.setdefault((int.from_bytes(suffix[:KEY], "big") >> 20) % pieces, []).append((suffix, left, doc, at, least, most))
            for target, run_ in dealt.items():
                run_.sort(key=lambda x: x[0])
                strings, lefts = [x[0] for x in run_], [x[1] for x in run_]
                rest = [np.array([x[i] for x in run_], np.int64) for i in range(2, 6)]
                rows.append({"target": target, "blob": front_code(strings, neighbours(strings), lefts, *rest)})
            apart: dict[int, list] = {}
            for name, found in windows.items():
                apart.setdefault(int.from_bytes(name[:4], "big") % pieces, []).append((*found, name))
            for target, found in apart.items():
                found.sort()
                ids, starts, several = (np.array(c, t) for c, t in zip(list(zip(*found))[:3], (np.int64, np.int64, np.uint8)))
                halves = np.frombuffer(b"".join(x[3] for x in found), np.uint64).reshape(-1, 2)
                rows.append({"target": target, "windows": pack(ids.view(np.uint64), starts, several, halves[:, 0], halves[:, 1])})
            for kept in (held, settled, whole, windows):
                kept.clear()
            return _table(_RUNS, rows)

        for batch in batches:
            out = []

            def settle(doc, at, least, most):
                out.append({"target": doc % pieces, "doc_id": doc, "first": at - most, "last": at - least + WINDOW})

            for doc, packed, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "places"))):
                raw = expand(packed)
                at, least, most, often = read_places(blob)
                keys = span_hash(prefix_hash(np.frombuffer(raw, np.uint8)), at, at + GRAM).astype(">u8").tobytes()
                for i, (p, lo, hi, hot) in enumerate(zip(at.tolist(), least.tolist(), most.tolist(), often.tolist())):
                    if hot:
                        name = hashlib.sha256(raw[p - hi : p - lo + WINDOW]).digest(), lo, hi
                        if name in whole:
                            settle(doc, p, lo, hi)
                            if name not in settled:
                                settled.add(name)
                                settle(*whole[name], lo, hi)
                            continue
                        whole[name] = doc, p
                        size += WINDOW_COST
                        for start in range(p - hi, p - lo + 1):
                            digest = hashlib.blake2b(raw[start : start + WINDOW], digest_size=16).digest()
                            met = windows.get(digest)
                            if met is None:
                                windows[digest] = [doc, start, 0]
                                size += WINDOW_COST
                                continue
                            met[2] = 1
                            if out and out[-1]["doc_id"] == doc and out[-1]["last"] == start - 1 + WINDOW:
                                out[-1]["last"] += 1
                            else:
                                settle(doc, start, 0, 0)
                        continue
                    suffix = keys[KEY * i : KEY * i + KEY] + raw[p : p - lo + WINDOW]
                    name = suffix, raw[p - hi : p][::-1], lo, hi
                    if name in held:
                        settle(doc, p, lo, hi)
                        if name not in settled:
                            settled.add(name)
                            settle(*held[name], lo, hi)
                    else:
                        held[name] = doc, p
                        size += len(suffix) + hi
            yield _table(_RUNS, out)
            if size >= HELD:
                yield send()
                size = 0
        yield send()

    return run


def repeated(strings_prefix: np.ndarray, lefts: list[bytes], least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For sorted suffixes, which windows occur twice: a row per suffix, a column per number of bytes before it.

    Two windows are equal where both have a bytes before the suffix, those agree, and the suffixes share the rest.  Suffixes that share n
    bytes are a run in their order, and so are left contexts in theirs; both are numbered anew for each a, and pairs of numbers compared.
    """
    n = len(lefts)
    order = np.array(sorted(range(n), key=lefts.__getitem__), np.int64)
    back = neighbours([lefts[i] for i in order])
    flags = np.zeros((n, int(most.max(initial=0)) + 1), bool)
    number = np.zeros(n, np.int64)
    for a in range(flags.shape[1]):
        use = np.flatnonzero((least <= a) & (a <= most))
        if len(use) < 2:
            continue
        right = np.cumsum(strings_prefix < KEY + WINDOW - a)
        number[order] = np.cumsum(back < a)
        pair = right[use] * (n + 1) + number[use]
        by = np.argsort(pair, kind="stable")
        equal = np.diff(pair[by]) == 0
        hit = np.append(equal, False) | np.append(False, equal)
        flags[use[by[hit]], a] = True
    return flags


def slices(group: np.ndarray, most: int) -> list[int]:
    """Where to cut sorted groups into slices of whole groups, of at most `most` rows unless one group has more."""
    cuts, begin, ends = [], 0, np.append(np.flatnonzero(np.diff(group)) + 1, len(group)).tolist()
    for end, following in zip(ends, ends[1:]):
        if following - begin > most:
            cuts.append(end)
            begin = end
    return cuts


def _merge(table: pa.Table) -> pa.Table:
    """Merge all runs of one target and give the spans of repeated windows."""
    doc, first, last = ([x for x in table.column(c).to_pylist() if x is not None] for c in ("doc_id", "first", "last"))
    apart = [unpack(b, *_WINDOWS) for b in table.column("windows").to_pylist() if b is not None]
    if apart:  # windows of hot anchors, by their digests
        ids, at, several, high, low = (np.concatenate(c) for c in zip(*apart))
        order = np.lexsort((low, high))
        equal = (np.diff(high[order]) == 0) & (np.diff(low[order]) == 0)
        again = several > 0
        again[order] |= np.append(equal, False) | np.append(False, equal)
        doc += ids[again].view(np.int64).tolist()
        first += at[again].tolist()
        last += (at[again] + WINDOW).tolist()
    runs = [decode(b) for b in table.column("blob").to_pylist() if b is not None]
    if runs:
        place = [(r, i, p) for r, i, p in LoserTree([(x[0], x[1]) for x in runs])]
        prefix = np.array([p for _, _, p in place], np.int64)
        base = np.append(0, np.cumsum([len(x[0]) for x in runs]))
        row = np.array([base[r] + i for r, i, _ in place], np.int64)
        numbers = np.concatenate([x[3] for x in runs], axis=1)[:, row]
        lefts = [runs[r][2][i] for r, i, _ in place]
        # Groups whose hash is alone have nothing to compare.
        group = np.cumsum(prefix < KEY)
        many = np.bincount(group)[group] > 1
        # A suffix between two others has the least prefix of both steps.
        kept = np.flatnonzero(many)
        for keep in np.split(kept, slices(group[kept], AT_ONCE)):
            flags = repeated(prefix[keep], [lefts[i] for i in keep], numbers[2][keep], numbers[3][keep])
            wide = np.zeros((len(keep), flags.shape[1] + 2), np.int8)
            wide[:, 1:-1] = flags
            edge = np.diff(wide, axis=1)
            who, low = np.nonzero(edge == 1)
            _, high = np.nonzero(edge == -1)
            ids, at = numbers[0][keep][who], numbers[1][keep][who]
            doc += ids.tolist()
            first += (at - high + 1).tolist()
            last += (at - low + WINDOW).tolist()
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


CUT = "doc_id long, n_removed long, n_spans long, cut_kept binary, kept_bytes binary"


def _cut(bytes_too: bool):
    def run(batches):
        for batch in batches:
            out = ([], [], [], [], [])
            for doc, packed, firsts, lasts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "firsts", "lasts"))):
                raw = expand(packed)
                a, b = union_spans(np.array(firsts), np.array(lasts))
                kept = b"".join(raw[x:y] for x, y in zip(np.append(0, b), np.append(a, len(raw))))
                for column, value in zip(out, (doc, int((b - a).sum()), len(a), hashlib.sha256(kept).digest(), kept if bytes_too else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            names = ["doc_id", "n_removed", "n_spans", "cut_kept", "kept_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return run


def suffix_dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Remove each byte covered by a 400-byte string that also starts anywhere else, in the same document or another.

    Suffixes are sorted at the places that every long repeat must share (see `repeats`): about one in 140, and of these only those whose next 128
    bytes occur again.  Each task sorts its suffixes (400 bytes at most, behind a hash of the first 128 that deals them evenly) and
    sends front-coded runs, with the bytes before each suffix; a loser tree merges the runs of a target and yields common prefixes of
    neighbours.  With the sorted left contexts they tell exactly which 400-byte windows around each place occur twice.
    Windows around an anchor of more than 2,000 places are dealt by their own 128-bit digests instead, so that no target holds them all.

    Texts are UTF-8; null is empty.  Returns a row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `texts` kept_bytes, null
    where nothing was removed.  Equal texts of 400 bytes or more are removed whole, all of them.  Rows of one doc_id are expected to have one
    text and count as copies; rows without doc_id only count as copies of others.  An empty table gives no rows; other columns are ignored.
    """
    pieces = targets(docs)
    documents, classes, cand = candidates(docs, measure, True, "bytes")
    sent = cand.mapInArrow(_runs(pieces), RUNS).repartition(pieces, "target")
    spans = sent.groupBy("target").applyInArrow(_merge, "doc_id long, first long, last long")
    spans = spans.groupBy("doc_id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    cut = cand.select("doc_id", "packed").join(spans, "doc_id").mapInArrow(_cut(texts), CUT)
    rows = documents.join(classes, "digest").join(cut, "doc_id", "left")
    copied = (F.col("copies") > 1) & (F.col("n") >= WINDOW)
    pick = lambda whole, some: F.when(copied, whole).otherwise(some)
    extra = [pick(F.lit(b""), F.col("kept_bytes")).alias("kept_bytes")] if texts else []
    return rows.select(
        "doc_id", F.col("n").alias("n_bytes"), pick(F.col("n"), F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        pick(F.lit(1), F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.lower(F.hex(pick(F.lit(EMPTY), F.coalesce("cut_kept", "kept")))).alias("kept_sha256"), *extra,
    )
