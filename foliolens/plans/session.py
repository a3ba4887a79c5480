"""Session settings the engine counts on; all can be set on a running session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins on (keys, chunk) must shuffle by all of their keys: with less, a side that is already laid out by
    # document would pull all chunks of a huge document into one task.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Groupings and windows may use a layout by some of their keys, such as (doc_id, chunk) for postings.
    "spark.sql.requireAllClusterKeysForDistribution": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(master: str | None = None, app: str = "foliolens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.cleaner.referenceTracking.cleanCheckpoints": "true", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(table: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a table whose files split into fewer tasks than cores.

    Parsing makes many rows out of one, so a handful of large splits would leave most cores
    idle.  A table with enough splits is returned as it is, without a shuffle; what is shuffled here has
    fewer splits than there are cores.
    """
    if table.isStreaming:
        return table
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, key)
