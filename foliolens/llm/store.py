"""Intermediate tables in the shared folder, sizes of inputs, and global ranks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliolens.plans.lineage import scratch

#: Input bytes (as the planner knows them) for each target of an exchange.
TARGET_BYTES = 6 << 20


def stage(table: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet in the shared folder and go on from there: cuts lineage, survives lost executors."""
    path = scratch(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def targets(table: DataFrame, floor: int | None = None) -> int:
    """Number of pieces to deal `table` to: grows with the planner's size of the table, never below the session's setting."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = floor or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, min(1 << 20, math.ceil(size / TARGET_BYTES) if size < 1 << 60 else 1))


def ranked(table: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Add `rank`, the place (from 0) of each row in the order of the given columns; also return the number of rows.

    Rows are range-partitioned and sorted; the number of rows in earlier partitions (one small row per partition)
    is added to the place inside the partition.
    """
    spark = table.sparkSession
    pieces = targets(table)
    table = stage(table, f"{name}-rows")  # range partitioning samples its input, which would compute it twice
    placed = stage(
        table.repartitionByRange(pieces, *order).sortWithinPartitions(*order).withColumn(
            "_at", F.monotonically_increasing_id()
        ),
        name,
    )
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    before, total = [], 0
    for row in counts:
        before.append((row["_part"], total))
        total += row["n"]
    starts = spark.createDataFrame(before, "_part long, _before long")
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn("rank", F.col("_before") + inside).drop("_part", "_before", "_at"), total


def fresh(table: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in table.columns}
    while name in taken:
        name = f"_{name}"
    return name


def extended(table: DataFrame, **added: str) -> T.StructType:
    """The table's schema with more columns."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    return T.StructType([*table.schema.fields, *(T.StructField(n, kinds[k]) for n, k in added.items())])
