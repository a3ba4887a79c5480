"""Candidate places of long repeats: anchors that every long enough repeat must share.

Of the grams inside a window, the one of the least hash is the window's anchor.  Equal windows have equal anchors at equal places, so only
windows around anchors that occur again need to be compared at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.jaccard import Sender, _table
from foliolens.llm.kernels import chunks, pack, unpack
from foliolens.llm.store import stage, targets

_PIECE = 1 << 20
_LOW = np.uint64((1 << 22) - 1)
#: Anchors that one task holds before it sends them.
HELD = 1_000_000
#: Places of one anchor beyond which its windows are dealt one by one, so that no task holds all of them.
HOT = 2_000
_HOT = np.uint16(1 << 15)


def sliding_argmin(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each i, the place of the least of hashes i .. i+width-1 (upper 42 bits; the first of equals)."""
    out = []
    for start in range(0, max(0, len(hashes) - width + 1), _PIECE):
        part = hashes[start : start + _PIECE + width - 1]
        low = (part & ~_LOW) | np.arange(len(part), dtype=np.uint64)
        step, have = 1, low
        while 2 * step <= width:
            have = np.minimum(have[:-step], have[step:])
            step *= 2
        if step < width:
            have = np.minimum(have[: len(part) - width + 1], have[width - step :])
        out.append((have & _LOW).astype(np.int64) + start)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def anchors(grams: np.ndarray, gram: int, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text, place of the anchor, key, least and most units of a window before its anchor).

    `first` has the first unit of each text and the end; `grams` the hash of `gram` units from each unit on.
    """
    place = sliding_argmin(grams, window - gram + 1)
    start = np.arange(len(place))
    text = np.searchsorted(first, start, "right") - 1
    inside = start + window <= first[text + 1] if len(text) else np.zeros(0, bool)
    start, place, text = start[inside], place[inside], text[inside]
    new = np.append(True, (np.diff(place) != 0) | (np.diff(text) != 0)) if len(place) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(place)) - 1 if len(begin) else begin
    at, which = place[begin], text[begin]
    return which, at - first[which], grams[at], at - start[end], at - start[begin]


SCAN = "target int, part string, doc_id long, n long, digest binary, kept binary, blob binary"
_SCAN = pa.schema([
    ("target", pa.int32()), ("part", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
    ("kept", pa.binary()), ("blob", pa.binary()),
])


def _scan(pieces: int, measure: Callable, within: bool):
    def run(batches):
        sender, seen, held = Sender(pieces, True), set(), []

        def send():
            part = sender.part()
            rows = [{"target": t, "part": part, "blob": b} for t, b in sender.flush()]
            rows.append({"part": part, "blob": pack(np.array(held, np.int64))})
            held.clear()
            return _table(_SCAN, rows)

        for rows, offsets, data in chunks(batches):
            ids = rows.column("doc_id").to_pylist()
            sizes, digests, kept, (text, at, key, least, most) = measure(offsets, data)
            yield _table(_SCAN, [
                {"doc_id": d, "n": n, "digest": g, "kept": k} for d, n, g, k in zip(ids, sizes, digests, kept)
            ])
            slot = np.full(len(ids), -1)
            for i, (doc, digest) in enumerate(zip(ids, digests)):
                if doc is not None and digest not in seen:
                    seen.add(digest)
                    slot[i] = len(held)
                    held.append(doc)
            use = slot[text] >= 0
            owner = slot[text[use]].astype(np.uint32)
            sender.add(key[use], owner, at[use].astype(np.uint32), least[use].astype(np.uint16), most[use].astype(np.uint16))
            if sender.size >= HELD:
                yield send()
        if held:
            yield send()

    return run


#: Of the key, the half that does not say the target: chance repeats only make a place a candidate for nothing.
_TYPES = (np.uint32, np.uint32, np.uint32, np.uint16, np.uint16)


def _again(within: bool, hot: int):
    """Anchors of one target whose key occurs again (in another document, unless `within`), those of more than `hot` places marked."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(b, *_TYPES) for b in table.column("blob").to_pylist()]
        key = np.concatenate([p[0] for p in parts])
        owner = np.concatenate([p[1].astype(np.int64) + (i << 32) for i, p in enumerate(parts)])
        order = np.argsort(key, kind="stable")
        equal = np.diff(key[order]) == 0
        again, mark = np.zeros(len(key), bool), np.zeros(len(key), np.uint16)
        begin = np.flatnonzero(np.append(True, ~equal)) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(key)))
        mark[order] = np.repeat(np.where(size > hot, _HOT, np.uint16(0)), size)
        if within:
            again[order] = np.append(equal, False) | np.append(False, equal)
        else:
            several = np.minimum.reduceat(owner[order], begin) != np.maximum.reduceat(owner[order], begin)
            again[order] = np.repeat(several, size)
        at, blobs = 0, []
        for p in parts:
            use = again[at : at + len(p[0])]
            most = p[4] | mark[at : at + len(p[0])]
            blobs.append(pack(*(c[use] for c in (p[1].astype(np.int64), p[2], p[3], most))))
            at += len(p[0])
        return pa.table({"part": table.column("part"), "blob": pa.array(blobs, pa.binary())})

    return run


def _places(table: pa.Table) -> pa.Table:
    """Per document of one part, its anchors that occur again, as a packed table sorted by place."""
    ids, found = None, []
    for head, blob in zip(table.column("head").to_pylist(), table.column("blob").to_pylist()):
        if head:
            ids = unpack(blob, np.int64)[0]
        else:
            found.append(unpack(blob, np.int64, *_TYPES[2:]))
    owner, at, least, most = (np.concatenate([f[i] for f in found]) for i in range(4)) if found else [np.zeros(0, np.int64)] * 4
    order = np.lexsort((at, owner))
    owner = owner[order]
    cut = np.searchsorted(owner, np.arange(len(ids) + 1))
    docs, blobs = [], []
    for i in np.flatnonzero(np.diff(cut)):
        rows = order[cut[i] : cut[i + 1]]
        docs.append(int(ids[i]))
        blobs.append(pack(at[rows], least[rows], most[rows]))
    return pa.table({"doc_id": pa.array(docs, pa.int64()), "places": pa.array(blobs, pa.binary())})


def read_places(blob: bytes) -> list[np.ndarray]:
    """Places of the anchors, least and most units of a window before each, and whether the anchor is hot."""
    at, least, most = unpack(blob, np.uint32, np.uint16, np.uint16)
    return [*(c.astype(np.int64) for c in (at, least, most & ~_HOT)), most >= _HOT]


PACKED = "doc_id long, packed binary, _own binary"


def _squeeze(batches):
    """Texts compressed one by one, since whole texts move between tasks, with their digests."""
    for batch in batches:
        texts = [t.as_py() for t in batch.column("text").fill_null("").cast(pa.large_binary())]
        packed = pa.array([squeeze(t) for t in texts], pa.binary())
        own = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed, own], ["doc_id", "packed", "_own"])


def squeeze(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def expand(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def candidates(docs: DataFrame, measure: Callable, within: bool, name: str, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan all texts for anchors and find those that occur again.

    `measure(offsets, data)` gives, for a chunk of texts, sizes, digests, hashes of what is kept if nothing is removed, and `anchors`.
    Equal texts are one class, represented by the smallest doc_id; only representatives become candidates.

    Returns (documents: doc_id, n, digest, kept), (classes: digest, rep, copies) and (candidates: doc_id, packed text, places).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = targets(docs)
    scanned = stage(texts.mapInArrow(_scan(pieces, measure, within), SCAN), f"{name}-anchors")
    documents = scanned.filter("n is not null").select("doc_id", "n", "digest", "kept")
    classes = documents.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    runs = scanned.filter("target is not null").select("target", "part", "blob").repartition(pieces, "target")
    again = runs.groupBy("target").applyInArrow(_again(within, hot), "part string, blob binary")
    heads = scanned.filter("target is null and n is null").select("part", F.lit(True).alias("head"), "blob")
    places = heads.unionByName(again.select("part", F.lit(False).alias("head"), "blob")).groupBy("part").applyInArrow(
        _places, "doc_id long, places binary"
    )
    # Copies in several tasks have the same places; those of the representative's text count.
    held = places.join(documents.select("doc_id", "digest").distinct(), "doc_id").groupBy("digest").agg(F.max("places").alias("places"))
    chosen = held.join(classes, "digest").select(F.col("rep").alias("doc_id"), "places", F.col("digest").alias("_digest"))
    squeezed = texts.filter("doc_id is not null").mapInArrow(_squeeze, PACKED)
    picked = squeezed.join(chosen, "doc_id").filter("_own = _digest").select("doc_id", "packed", "places").dropDuplicates(["doc_id"])
    return documents, classes, stage(picked, f"{name}-candidates")


def union_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    begin = np.flatnonzero(new)
    return starts[begin], ends[np.append(begin[1:], len(starts)) - 1]
