"""Exact dedup against a minimal perfect hash over the digests of earlier documents."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.kernels import mix
from foliolens.llm.store import extended, fresh, stage

#: Digests in each shard of the hash on average, which bounds what one task holds.
SHARD_KEYS = 50_000
LEVELS = 48
DIGESTS = "doc_id long, digest binary, part long"


def _digests(batches):
    for batch in batches:
        texts = batch.column("text").fill_null("").cast(pa.large_binary())
        found = [hashlib.sha256(t.as_py().lower()).digest() for t in texts]
        first = [int.from_bytes(d[:4], "big") for d in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, pa.binary()), pa.array(first, pa.int64())], ["doc_id", "digest", "part"]
        )


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes from rows of 32 digest bytes."""
    wide = np.ascontiguousarray(digests[:, 8:24]).view("<u8")
    return wide[:, 0], wide[:, 1] | np.uint64(1)


class PerfectHash:
    """Minimal perfect hash by levels of bits: a key that is alone in its cell at a level gets the cell's rank as slot."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, left: np.ndarray):
        self.sizes, self.left = sizes, left
        self.begin = np.append(0, np.cumsum(sizes))
        self.bits = bits
        self.rank = np.append(0, np.cumsum(bits))

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        a, b = _halves(digests)
        rest, sizes, planes = np.arange(len(digests)), [], []
        for level in range(LEVELS):
            if not len(rest):
                break
            size = max(8, 2 * len(rest))
            cell = (mix(a[rest] + np.uint64(level) * b[rest]) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cell, minlength=size) == 1
            planes.append(alone)
            sizes.append(size)
            rest = rest[~alone[cell]]
        bits = np.concatenate(planes) if planes else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), bits, digests[rest])

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """Slot of every member; for others any slot or -1, so callers compare the digest in the slot."""
        a, b = _halves(digests)
        out, rest = np.full(len(digests), -1), np.arange(len(digests))
        for level, size in enumerate(self.sizes):
            cell = (mix(a[rest] + np.uint64(level) * b[rest]) % np.uint64(size)).astype(np.int64) + self.begin[level]
            hit = self.bits[cell]
            out[rest[hit]] = self.rank[cell[hit]]
            rest = rest[~hit]
        if len(self.left):  # keys that met another at every level: told apart by the whole digest
            known = {d.tobytes(): i for i, d in enumerate(self.left)}
            total = int(self.rank[-1])
            for i in rest:
                place = known.get(digests[i].tobytes(), -1)
                out[i] = -1 if place < 0 else total + place
        return out

    def dump(self) -> tuple[bytes, bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.bits).tobytes(), self.left.tobytes()

    @classmethod
    def load(cls, sizes: bytes, bits: bytes, left: bytes) -> PerfectHash:
        n = np.frombuffer(sizes, np.int64)
        plain = np.unpackbits(np.frombuffer(bits, np.uint8))[: int(n.sum())].astype(bool)
        return cls(n, plain, np.frombuffer(left, np.uint8).reshape(-1, 32))


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


INDEX = "shard long, sizes binary, bits binary, rest binary, slots binary, winners array<long>, counts array<long>"


def _build(table: pa.Table) -> pa.Table:
    digests = _rows(table.column("digest"))
    tree = PerfectHash.build(digests)
    order = np.argsort(tree.slots(digests))
    sizes, bits, left = tree.dump()
    pick = lambda name: table.column(name).take(pa.array(order)).to_pylist()
    return pa.table(
        {
            "shard": [table.column("shard")[0].as_py()], "sizes": [sizes], "bits": [bits], "rest": [left],
            "slots": [digests[order].tobytes()], "winners": [pick("winner")], "counts": [pick("n")],
        },
        schema=pa.schema([
            ("shard", pa.int64()), ("sizes", pa.binary()), ("bits", pa.binary()), ("rest", pa.binary()),
            ("slots", pa.binary()), ("winners", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ]),
    )


def _shard(shards: int):
    return F.pmod("part", F.lit(shards)).alias("shard")


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """One row per shard: the hash, a full digest per slot, and the winner (largest doc_id) and count of each."""
    distinct = digests.groupBy("digest", "part").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    return distinct.select("digest", "winner", "n", _shard(shards)).groupBy("shard").applyInArrow(_build, INDEX)


def _look_up(index: pa.Table, arrivals: pa.Table) -> pa.Table:
    """Groups of one shard after the arrivals: members update their slot, others form groups of their own."""
    digests, winners, counts = np.zeros((0, 32), np.uint8), [], []
    new, ids, sizes = _rows(arrivals.column("digest")), arrivals.column("winner").to_pylist(), arrivals.column("n").to_pylist()
    member = np.zeros(len(new), bool)
    if index.num_rows:
        row = index.to_pylist()[0]
        digests, winners, counts = np.frombuffer(row["slots"], np.uint8).reshape(-1, 32), row["winners"], row["counts"]
        slots = PerfectHash.load(row["sizes"], row["bits"], row["rest"]).slots(new)
        member = slots >= 0
        member[member] = (digests[slots[member]] == new[member]).all(axis=1)
        for i in np.flatnonzero(member):
            s = slots[i]
            winners[s] = max((x for x in (winners[s], ids[i]) if x is not None), default=None)
            counts[s] += sizes[i]
    others = np.flatnonzero(~member)
    return pa.table({
        "digest": pa.array([d.tobytes() for d in digests] + [new[i].tobytes() for i in others], pa.binary()),
        "keep_id": pa.array([*winners, *(ids[i] for i in others)], pa.int64()),
        "group_size": pa.array([*counts, *(sizes[i] for i in others)], pa.int64()),
    })


def exact_dedup(history: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Group the rows of both tables by text and keep the row with the largest doc_id of each group.

    Texts are equal when identical after lower-casing A-Z.  A minimal perfect hash is built over the distinct digests
    of `history`, in shards of bounded size; each slot holds the full digest and the winner so far.  Distinct
    digests of `arrivals` look their slot up and compare all bytes of the digest: repeats join the slot's
    group, others form new groups.  Texts are read once and never shuffled; rows are counted per digest before any shuffle.

    Returns a row per input row: doc_id, keep_id, group_size, kept, text_sha256.  Null text counts as empty.  Repeated
    rows of one doc_id are counted in group_size and are all kept when their doc_id is.  A null doc_id loses to any other;
    where all are null, keep_id is null and all are kept.  Empty tables give no rows; other columns are ignored.
    """
    rows = [t.select(F.col("doc_id").cast("long"), "text").mapInArrow(_digests, DIGESTS) for t in (history, arrivals)]
    both = stage(rows[0].withColumn("old", F.lit(True)).unionByName(rows[1].withColumn("old", F.lit(False))), "digests")
    old, new = both.filter("old"), both.filter("not old")
    shards = max(1, math.ceil(old.count() / SHARD_KEYS), math.ceil(new.count() / SHARD_KEYS))
    index = build_index(old, shards)
    distinct = new.groupBy("digest", "part").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    arriving = distinct.select("digest", "winner", "n", _shard(shards))
    groups = (
        index.groupBy("shard")
        .cogroup(arriving.groupBy("shard"))
        .applyInArrow(_look_up, "digest binary, keep_id long, group_size long")
    )
    return both.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents in the lower half of the range of doc_id, as an earlier load would have brought them, and the others."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    earlier = F.coalesce(F.col("doc_id") <= F.lit(((low or 0) + (high or 0)) // 2), F.lit(False))
    return docs.filter(earlier), docs.filter(~earlier)


def _with_digest(name: str):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            own = pa.array([hashlib.sha256(t.as_py().lower()).hexdigest() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, name])

    return run


def largest_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their columns unchanged: rows are decided by doc_id and text, and of repeated ones that stay one does.

    Rows of one doc_id with different texts are each held against the rows of their own text.  Rows without doc_id lose to rows that have one.
    """
    own, doc = fresh(docs, "own"), fresh(docs, "winner")
    kept = exact_dedup(*halves(docs)).filter("kept").select(F.col("doc_id").alias(doc), F.col("text_sha256").alias(own)).distinct()
    rows = docs.mapInArrow(_with_digest(own), extended(docs, **{own: "string"}))
    match = rows["doc_id"].cast("long").eqNullSafe(kept[doc]) & (rows[own] == kept[own])
    return rows.join(kept, match, "left_semi").dropDuplicates(["doc_id", own]).select(*docs.columns)
