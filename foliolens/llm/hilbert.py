"""Shards along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliolens.llm.store import ranked, stage, targets

BITS = 4


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of cells (rows of d coordinates below 2^bits): Gray-code axes are undone from the top bit down."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where(x[d - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _text_cuts(rows: DataFrame, column: str, steps: list[float]) -> list[str | None]:
    """Quantiles of a text column over all rows, by whole values: nulls are lowest, and a value is weighed by its rows.

    Distinct values are counted, dealt to tasks by range, and only the tasks in which a quantile falls are looked into.
    """
    counted = stage(rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")), f"{column}-counts")
    dealt = counted.repartitionByRange(targets(counted), column).withColumn("_part", F.spark_partition_id())
    dealt = stage(dealt, f"{column}-ranges")
    parts = dealt.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect()  # a row per task
    total, before, wanted = sum(r["n"] for r in parts), 0, []
    for r in parts:
        places = {max(1, math.ceil(step * total)) - before for step in steps}
        wanted += [(r["_part"], place) for place in places if 0 < place <= r["n"]]
        before += r["n"]
    if not wanted:
        return []
    up_to = F.sum("n").over(W.partitionBy("_part").orderBy(column))
    inside = dealt.filter(F.col("_part").isin(sorted({part for part, _ in wanted}))).withColumn("_up", up_to)
    hit = F.expr(" or ".join(f"(_part = {part} and _up >= {place} and _up - n < {place})" for part, place in wanted))
    return [r[column] for r in inside.filter(hit).select(column).collect()]


def _above(column: str, cut: str | float | None) -> Column:
    return F.col(column).isNotNull() if cut is None else F.col(column) > F.lit(cut)


def _curve(dimensions: int, bits: int, fields: list[str]):
    def add(batches):
        for batch in batches:
            cells = np.array([batch.column(f"_c{i}").to_numpy(zero_copy_only=False) for i in range(dimensions)]).T
            curve = curve_index(cells.reshape(-1, dimensions), bits)
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in fields), pa.array(curve, pa.int64())], [*fields, "curve"])

    return add


def hilbert_shards(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """Deal documents to shards along a Hilbert curve over language, source and text size.

    Each dimension is quantised at quantiles of all rows (2^bits cells at most), so that a dense range gets more cells; languages and
    sources are compared as whole values.  Rows are sorted by curve index, then by a checksum of the text and doc_id, and cut into runs of equal
    row counts: neighbours on the curve share a shard, so its files cover narrow ranges of all dimensions.  Equal texts of one cell
    are next to each other; those of different languages or sources may lie in different shards, as may a group that a cut falls into.

    Returns a row per input row: doc_id, size (UTF-8 bytes plus 1), text_crc32, law (`rows`: counts are at most one apart), shard, slot (from 0,
    without gaps), grown_shard (null), curve.  Null text has size 1 and checksum 0; null languages and sources are lowest;
    repeated rows take places of their own and ties on all three sort keys any order; an empty table gives no rows; other columns are ignored.
    Texts of any length are only measured, never shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("lang").cast("string").alias("_d0"),
        F.col("source").cast("string").alias("_d1"),
        F.log2((F.octet_length(text) + 1).cast("double")).alias("_d2"),
    )
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    sizes = rows.agg(F.percentile_approx("_d2", steps, 1000)).first()[0] or []
    cuts = [_text_cuts(rows, "_d0", steps), _text_cuts(rows, "_d1", steps), sorted(set(sizes))]
    cell = [
        sum((F.when(_above(f"_d{i}", c), 1).otherwise(0) for c in found), F.lit(0)).cast("int").alias(f"_c{i}")
        for i, found in enumerate(cuts)
    ]
    fields = ["doc_id", "size", "text_crc32"]
    schema = "doc_id long, size long, text_crc32 long, curve long"
    curved = rows.select(*fields, *cell).mapInArrow(_curve(3, bits, fields), schema)
    placed, total = ranked(curved, ["curve", "text_crc32", "doc_id"], "curve")
    shard = F.expr(f"rank * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write the documents as one folder per shard, sorted along the curve.  Rows of one doc_id must not repeat."""
    places = hilbert_shards(docs, shards).select("doc_id", "shard", "slot")
    placed = docs.drop("shard", "slot").join(places, "doc_id")
    placed.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
