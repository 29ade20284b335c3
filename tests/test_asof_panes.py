"""As-of join and sliding windows by panes against the plain forms."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from topiclake.operators import extensions as E
from topiclake.operators.asof import as_of


def plain(left, right):
    out = Counter()
    for k, i, t in left:
        best = [(u, v) for q, u, v in right if k is not None and t is not None and q == k and u is not None and u <= t]
        out[i, max(best, key=lambda x: (x[0], x[1] is not None, x[1] or 0))[1] if best else None] += 1
    return out


@pytest.mark.parametrize("method,slices", [("window", None), ("split", None), ("split", 1), ("split", 7), ("split", 40)])
def test_as_of(spark, method, slices):
    rng = random.Random(9)
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "lonely", None])
    left = [(key(), i, rng.choice([None, *range(200)])) for i in range(300)]
    right = [(k, rng.choice([None, *range(200)]), rng.choice([None, rng.randrange(9)])) for k in (key() for _ in range(120)) if k != "lonely"]
    stamp = F.timestamp_seconds(F.col("s"))
    l = spark.createDataFrame(left, "k STRING, i INT, s LONG").withColumn("at", stamp)  # noqa: E741
    r = spark.createDataFrame(right, "k STRING, s LONG, v INT").withColumn("at", stamp)
    out = as_of(l, r, "k", "at", "at", ["v"], method=method, slices=slices)
    assert out.columns == ["k", "i", "s", "at", "v"]
    assert Counter((x.i, x.v) for x in out.collect()) == plain(left, right)


def test_as_of_empty_sides(spark):
    l = spark.createDataFrame([("a", 1)], "k STRING, s LONG").withColumn("at", F.timestamp_seconds("s"))  # noqa: E741
    for slices in (None, 3):
        assert [x.v for x in as_of(l, l.limit(0).withColumn("v", F.lit(1)), "k", "at", "at", ["v"], slices=slices).collect()] == [None]
        assert as_of(l.limit(0), l.withColumn("v", F.lit(1)), "k", "at", "at", ["v"], slices=slices).count() == 0
    with pytest.raises(ValueError):
        as_of(l, l, "k", "at", "at", ["s"], method="x")


@pytest.mark.parametrize("size,slide", [("2 hours", "1 hour"), ("90 minutes", "1 hour"), ("1 hour", "1 hour"), ("24 hours", "5 minutes"), ("50 seconds", "20 seconds")])
def test_panes_equal_windows(spark, size, slide):
    df = spark.range(500).selectExpr("timestamp_micros(id * 7919 * 1000003 % 400000000000 - 100000000000) AS event_time", "CAST(id % 3 AS STRING) AS event_type")
    df = df.unionByName(spark.createDataFrame([(None, "0")], "event_time TIMESTAMP, event_type STRING"))
    got, want = E.sliding_counts(df, size, slide), E.sliding_counts(df, size, slide, method="window")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_panes_copy_no_event(spark):
    df = spark.range(10).selectExpr("timestamp_seconds(id) AS event_time", "'a' AS event_type")
    lines = E.sliding_counts(df, "24 hours", "5 minutes")._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, x in enumerate(lines) if "Generate" in x or "Expand" in x]
    first = max(i for i, x in enumerate(lines) if "HashAggregate" in x and "partial_count" in x)
    assert at and all(i < first for i in at)  # the tree is printed from the top: rows are aggregated below
