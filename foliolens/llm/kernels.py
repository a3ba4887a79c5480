"""Array kernels over Arrow text columns: chunks, words, n-gram hashes, packed runs."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, kind: str, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(
    batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, most: int = CHUNK_ROWS
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into slices of few text bytes and rows: (rows, text offsets from 0, text bytes).  Null texts count as empty."""
    for batch in batches:
        text = batch.column("text").fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
        first, rows = 0, len(text)
        while first < rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(rows, first + most, max(first + 1, last))
            yield batch.slice(first, last - first), offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
            first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; `span_hash` takes hashes of spans from it."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, "up", len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    down = _power(_INVERSE, "down", len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of every text, and the first word of each text (plus the end)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.append(True, space[:-1]), np.append(space[1:], True)
    before[offsets[offsets < len(data)]] = True
    after[offsets[offsets > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), starts, ends)


def gram_hashes(tokens: np.ndarray, n: int) -> np.ndarray:
    """Hash of tokens i .. i+n-1 for each i (empty with fewer tokens)."""
    size = len(tokens) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for i in range(n):
        total = total * _BASE + tokens[i : i + size]
    return mix(total)


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: much faster on long integer arrays than hashing them."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])] if len(a) else a


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of start .. start+length-1, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.append(0, np.cumsum(lengths)[:-1]), lengths)
    return first + np.arange(total)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed byte planes; ascending unsigned keys in the first are stored as differences."""
    parts = []
    for i, a in enumerate(arrays):
        if i == 0 and a.dtype.kind == "u" and len(a):
            a = np.append(a[:1], np.diff(a)).astype(a.dtype)
        a = np.ascontiguousarray(a)
        parts.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    head = np.array([len(arrays[0])], np.int64).tobytes()
    return head + zlib.compress(b"".join(parts), 1)


def unpack(blob: bytes, *types: type) -> list[np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    raw, at, out = np.frombuffer(zlib.decompress(blob[8:]), np.uint8), 0, []
    for i, kind in enumerate(types):
        width = np.dtype(kind).itemsize
        a = np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).reshape(n)
        at += n * width
        out.append(np.cumsum(a, dtype=kind) if i == 0 and np.dtype(kind).kind == "u" else a)
    return out
