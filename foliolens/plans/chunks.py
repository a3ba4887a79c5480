"""Ordered work inside groups of any size.

A window over a whole group puts the group into one task.  Here a group is cut into chunks along
its order: rows are shuffled by (keys, chunk), each chunk is summarised in one row, the summaries
of a group are combined by a window that sees one row per chunk, and the combined values are joined back
on (keys, chunk).  The join and the windows inside a chunk share one shuffle, results are exact,
and no task depends on the size of a group.

`chunk` names a column whose order agrees with the row order inside the group: all rows of a
smaller chunk come before all rows of a larger one.  Key and chunk columns must not be null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 4096


def chunk_of(position: str | Column, size: int = ROWS_PER_CHUNK) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / size).cast("long")


class ChunkWindows:
    """Windows over the summary rows of one group."""

    def __init__(self, keys: list[str], chunk: str):
        self.whole = Window.partitionBy(*keys)
        self.ordered = self.whole.orderBy(chunk)
        self.before = self.ordered.rowsBetween(Window.unboundedPreceding, -1)
        self.through = self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry(
    rows: DataFrame,
    keys: list[str],
    chunk: str,
    summaries: list[Column],
    combine: Callable[[DataFrame, ChunkWindows], DataFrame],
) -> DataFrame:
    """Join to every row what `combine` derives from the chunk summaries of its group."""
    per_chunk = rows.groupBy(*keys, chunk).agg(*summaries)
    combined = combine(per_chunk, ChunkWindows(keys, chunk))
    return rows.join(combined, [*keys, chunk], "inner")


class Neighbours:
    """The value of the previous and of the next row, across chunk borders.

    `summaries` and `combine` go into `carry`; `previous` and `following` are used on its result.
    The value is a struct, so a null inside it is told apart from a missing neighbour.
    """

    def __init__(self, keys: list[str], chunk: str, order: list[str], value: Column):
        self.value = value
        self.inner = Window.partitionBy(*keys, chunk).orderBy(*order)
        rank = F.struct(*order)
        self.summaries = [
            F.min_by(value, rank).alias("_first_value"),
            F.max_by(value, rank).alias("_last_value"),
        ]

    @staticmethod
    def carried(windows: ChunkWindows) -> list[Column]:
        return [
            F.lag("_last_value").over(windows.ordered).alias("_previous_chunk"),
            F.lead("_first_value").over(windows.ordered).alias("_next_chunk"),
        ]

    def previous(self) -> Column:
        return F.coalesce(F.lag(self.value).over(self.inner), F.col("_previous_chunk"))

    def following(self) -> Column:
        return F.coalesce(F.lead(self.value).over(self.inner), F.col("_next_chunk"))


def numbered(
    rows: DataFrame, keys: list[str], chunk: str, order: list[Column | str], position: str, total: str | None = None
) -> DataFrame:
    """Dense 0-based position of each row in its group, and optionally the group's row count."""

    def combine(part: DataFrame, w: ChunkWindows) -> DataFrame:
        columns = [*keys, chunk, F.coalesce(F.sum("_n").over(w.before), F.lit(0)).alias("_offset")]
        if total:
            columns.append(F.sum("_n").over(w.whole).alias(total))
        return part.select(*columns)

    inner = Window.partitionBy(*keys, chunk).orderBy(*order)
    joined = carry(rows, keys, chunk, [F.count(F.lit(1)).alias("_n")], combine)
    return joined.withColumn(position, F.col("_offset") + F.row_number().over(inner) - 1).drop("_offset")


def running_sum(
    rows: DataFrame, keys: list[str], chunk: str, order: list[Column | str], value: str, name: str
) -> DataFrame:
    """Sum of an integer column over the group's rows up to and including the current one."""

    def combine(part: DataFrame, w: ChunkWindows) -> DataFrame:
        return part.select(*keys, chunk, F.coalesce(F.sum("_sum").over(w.before), F.lit(0)).alias("_offset"))

    inner = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = carry(rows, keys, chunk, [F.sum(value).alias("_sum")], combine)
    return joined.withColumn(name, F.col("_offset") + F.sum(value).over(inner)).drop("_offset")


def attach(rows: DataFrame, keys: list[str], chunk: str, per_group: DataFrame, how: str = "left") -> DataFrame:
    """Join one-row-per-group values to rows of groups of any size, spread by chunk."""
    present = rows.select(*keys, chunk).distinct()
    return rows.join(present.join(per_group, keys, how), [*keys, chunk], "inner")
