"""The parse cache as a stream: each run parses the files that came since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def parse_new(
    spark: SparkSession,
    folder: str,
    schema: str,
    parse: Callable[[DataFrame], DataFrame],
    cache: str,
    progress: str,
) -> StreamingQuery:
    """Parse all Parquet files of `folder` not seen before into the cache table, then stop.

    `parse` must be row-local.  The file log below `progress` (a folder shared by all executors) replaces the
    lookup of each path in the cache, and the file sink's commit log makes every file's blocks appear once.
    """
    arrivals = spark.readStream.schema(schema).parquet(folder)
    return (
        parse(arrivals)
        .writeStream.format("parquet")
        .option("path", cache)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
