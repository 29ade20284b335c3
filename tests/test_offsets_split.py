"""Offsets by cut buckets equal the plain window, whatever is hot; nothing stays persisted."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topiclake.operators.offsets import assign_offsets


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("leaf", [1, 3, 40, 10_000])
def test_hot_group_key_and_copies(spark, leaf):
    rows = [("hot", 0, i % 50, f"v{i % 7}") for i in range(600)] + [("hot", 0, 999, "same")] * 300 + [("hot", 0, None, None)] * 90
    rows += [("cold", 1, i, "v") for i in range(40)] + [(None, None, -(2**63), "a"), (None, None, 2**63 - 1, "b")]
    df = spark.createDataFrame(rows, "topic STRING, partition INT, key BIGINT, value STRING").repartition(5)
    for order in (("key", F.xxhash64("value")), ("key", "value")):
        got = assign_offsets(df, order=order, leaf_rows=leaf)
        assert collected(got) == collected(assign_offsets(df, order=order, method="window"))


def test_no_partition_is_much_larger_than_a_leaf(spark):
    df = spark.range(5000).selectExpr("'t' AS topic", "0 AS partition", "id % 10 AS key", "CAST(id % 100 AS STRING) AS value")
    from topiclake.operators import offsets as O

    rows, cuts = O._cut(O.with_tie(df).withColumn(O._RANK, F.array(F.col("key"), F.xxhash64("value"), F.col(O.TIE))), ["topic", "partition"], 3, 20)
    assert rows.groupBy("topic", "partition", *cuts).count().agg(F.max("count")).first()[0] <= 20


def test_small_and_joined_frames(spark):
    two = spark.createDataFrame([("a", 0, 1, "x"), ("a", 0, 2, "x")], "topic STRING, partition INT, key BIGINT, value STRING")
    assert [r.offset for r in assign_offsets(two).orderBy("key").collect()] == [0, 1]
    joined = two.join(two.select("key", F.lit(1).alias("one")), "key")
    out = assign_offsets(joined)
    assert out.count() == 2 and out.rdd.getNumPartitions() < 1000


def test_one_row_exchange_and_nothing_persisted(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.range(400).selectExpr("'t' AS topic", "CAST(id % 3 AS INT) AS partition", "id AS key", "repeat('x', 50) AS value")
    out = assign_offsets(df, order=("key", F.xxhash64("value")), leaf_rows=30)
    assert out.count() == 400
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan and "rangepartitioning" not in plan
    assert "Range (" not in plan  # every pass reads the rows written once, none makes them again
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_small_inputs_go_through_the_window_in_one_scan(spark, sf):
    from topiclake.operators import offsets as O
    from topiclake.plans import topics as P

    out = P.build_bronze(spark, sf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan json") == 3 and plan.count("Exchange") == 1  # one scan a topic
    keep, O.SMALL_BYTES = O.SMALL_BYTES, 0
    try:
        staged = P.build_bronze(spark, sf)
        assert "Scan json" not in staged._jdf.queryExecution().executedPlan().toString()
        assert collected(staged.select("topic", "partition", "offset", "key")) == collected(out.select("topic", "partition", "offset", "key"))
    finally:
        O.SMALL_BYTES = keep
