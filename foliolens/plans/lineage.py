"""Cutting lineage through the shared checkpoint folder, and small-side checks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 << 20
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the cluster names, or a test folder in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="foliolens-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(table: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there."""
    shared_folder(table.sparkSession)
    return table.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written and read back; `drop_scratch` deletes them all."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the tables written by `scratch` in this process, once nothing reads them any more; gives their number."""
    found = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        found += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return found


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> bool:
    """Whether the table has at most so many rows and bytes (as JSON text); reads no more than one row above the limit."""
    size = F.octet_length(F.to_json(F.struct(*table.columns)))
    measured = table.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
    return measured["rows"] <= rows and (measured["bytes"] or 0) <= bytes_


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salt: str | None = None, pieces: int = 64
) -> DataFrame:
    """Join a lookup table, written out first so that its size is known, to a big one whose keys may be skewed."""
    return sized_join(big, cut(small), on, how, salt or on[0], pieces)


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str, salt: str, pieces: int = 64, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join by broadcast where a count proves that `small` fits, with at most so many `rows`.

    Beyond that, rows of one key are spread over `pieces` by a hash of the `salt` column and the lookup is
    repeated for each piece, so that no task gets all rows of a hot key.
    """
    if fits_broadcast(small, rows):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, salt, pieces)


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str, salt: str, pieces: int = 16
) -> DataFrame:
    """Shuffled join that cuts every key of `big` into `pieces`; `small` is repeated per piece."""
    left = big.withColumn("_piece", F.pmod(F.xxhash64(salt), F.lit(pieces)).cast("int"))
    return left.join(repeated_for(small, pieces), [*on, "_piece"], how).drop("_piece")


def repeated_for(small: DataFrame, pieces: int) -> DataFrame:
    """Each row of `small` once for each `_piece`, never to be broadcast: the planner takes all pieces together for as large as one."""
    return small.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).hint("merge")


def if_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join: broadcast where a count proves that it fits, else shuffled, whatever size its files suggest."""
    return F.broadcast(table) if fits_broadcast(table, rows) else table.hint("merge")
