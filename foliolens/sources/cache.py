"""Parsed-block cache: documents parsed before are not parsed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cache_key(path: Column | str, modified: Column | None = None) -> Column:
    """MD5 of the path, or of path and change time, under which an edited file is new again."""
    path = F.col(path) if isinstance(path, str) else path
    return F.md5(path if modified is None else F.concat_ws("|", path, modified.cast("string")))


def new_documents(documents: DataFrame, cache: DataFrame, key: Column) -> DataFrame:
    """Documents whose key is not in the cache table."""
    known = cache.select("cache_key").distinct()
    return documents.withColumn("cache_key", key).join(known, "cache_key", "left_anti")
