"""Key partition and key time (X4–X6, X9; FIXTURES §4)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topiclake.functions.keys import key_partition, key_time


def test_keys_0_to_9(spark):
    df = spark.range(10).select(key_partition("id").alias("p")).orderBy(F.monotonically_increasing_id())
    assert [r.p for r in df.collect()] == [2, 1, 1, 0, 2, 2, 0, 0, 1, 2]


def test_null_key_goes_to_partition_0(spark):
    df = spark.createDataFrame([(None,)], "k BIGINT")
    assert df.select(key_partition("k").alias("p")).first().p == 0


def test_int_min_hash_does_not_overflow(spark):
    # The modulo step on the widened hash: abs(-2147483648) % 3 == 2.
    h = F.lit(-2147483648).cast("int").cast("bigint")
    assert spark.range(1).select((F.abs(h) % 3).alias("p")).first().p == 2
    with pytest.raises(Exception):
        spark.range(1).select(F.abs(F.lit(-2147483648).cast("int")).alias("x")).collect()


def test_int_and_bigint_keys_hash_alike_after_cast(spark):
    df = spark.createDataFrame([(1, 1)], "i INT, l BIGINT")
    r = df.select(F.hash("i").alias("hi"), F.hash("l").alias("hl"),
                  key_partition("i").alias("pi"), key_partition("l").alias("pl")).first()
    assert r.hi != r.hl
    assert r.pi == r.pl


def test_key_as_time(spark):
    r = spark.createDataFrame([(7,)], "k BIGINT").select(F.date_format(key_time("k"), "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert r.first().t == "1970-01-01 00:00:07"
