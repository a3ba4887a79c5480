from __future__ import annotations

import random

import pytest

from foliolens.plans import chunks as ck
from foliolens.plans.lineage import fits_broadcast, lookup_join, salted_join


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_numbering_and_running_sum(rows, size):
    rng = random.Random(size)
    data = [(k, i * 2 + k, rng.randrange(3)) for k in range(3) for i in range(10 * k + 1)]
    frame = rows("k int, at int, v int", data).withColumn("c", ck.chunk_of("at", size))
    numbered = {(r.k, r["at"]): (r.p, r.n) for r in ck.numbered(frame, ["k"], "c", ["at"], "p", "n").collect()}
    sums = {(r.k, r["at"]): r.s for r in ck.running_sum(frame, ["k"], "c", ["at"], "v", "s").collect()}
    for k in range(3):
        group = [x for x in data if x[0] == k]
        total = 0
        for i, (_, at, v) in enumerate(group):
            total += v
            assert numbered[(k, at)] == (i, len(group))
            assert sums[(k, at)] == total


def test_joins_with_and_without_broadcast(rows):
    big = rows("k int, i int", [(i % 3, i) for i in range(300)])
    small = rows("k int, name string", [(0, "a"), (1, "b")])
    assert fits_broadcast(small, 2) and not fits_broadcast(small, 1) and not fits_broadcast(small, 2, 10)
    wide = sorted(map(tuple, lookup_join(big, small, ["k"], "left").collect()), key=str)
    salted = sorted(map(tuple, salted_join(big, small, ["k"], "left", salt="i").collect()), key=str)
    assert wide == salted and len(wide) == 300
    assert salted_join(big, small, ["k"], "left_anti", salt="i").count() == 100


def test_repeated_pieces_are_not_broadcast(rows):
    """The planner would take 64 copies of a small table for as large as one, and send them all through the driver."""
    big = rows("k int, i int", [(i % 3, i) for i in range(300)])
    small = rows("k int", [(0,), (1,)])
    for how in ("left_semi", "left_anti", "left", "inner"):
        joined = salted_join(big, small, ["k"], how, salt="i", pieces=64)
        joined.collect()
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_group_is_spread_over_tasks(spark, rows):
    """One document holds all rows; the shuffle by (key, chunk) still gives every task some."""
    from pyspark.sql import functions as F

    frame = spark.range(40_000).select(F.lit(7).alias("k"), F.col("id").alias("at")).withColumn("c", ck.chunk_of("at", 100))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = ck.numbered(frame, ["k"], "c", ["at"], "p").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(placed) == 4
    assert max(r["count"] for r in placed) < 20_000
