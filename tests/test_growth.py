"""Types of rescued members: the least that holds all values, in any order and split."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from topiclake.operators import growth

CASES = {
    "whole": (["1", "-20", "0"], "BIGINT"),
    "decimal": (["1", "2.50", "0.125"], "DECIMAL(23,3)"),
    "double": (["1", "2.5", "1e300"], "DOUBLE"),
    "text": (["1", "x"], "STRING"),
    "words": (["007", "", "null", "nan"], "STRING"),
    "truth": (["true", "false"], "BOOLEAN"),
    "truth_or_not": (["true", "1"], "STRING"),
    "object": (['{"a":1}', '{"a":2.5,"b":"x"}'], "STRUCT<a: DECIMAL(21,1), b: STRING>"),
    "list": (["[1,2]", "[]", "[3.5]"], "ARRAY<DECIMAL(21,1)>"),
    "broken": (['{"a":', "[1"], "STRING"),
    "object_or_list": (['{"a":1}', "[1]"], "STRING"),
}


def rescued(spark, rows):
    return spark.createDataFrame([(i, "t", m) for i, m in enumerate(rows)], "key LONG, topic STRING, _rescued MAP<STRING,STRING>")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_types_in_any_order(spark, seed):
    rows = [{m: v} for m, (values, _) in CASES.items() for v in values] + [{}, None, {"never": None}]
    random.Random(seed).shuffle(rows)
    got = {r.member: r.type for r in growth.member_types(rescued(spark, rows).repartition(1 + seed * 3)).collect()}
    assert got == {m: t for m, (_, t) in CASES.items()}


def test_values(spark):
    rows = [{"n": "1", "s": "x", "key": "kept"}, {"n": "2.5", "o": '{"a":1}'}, {}, None, {"s": "1", "o": '{"a":3,"b":[1]}'}]
    out = growth.grown(rescued(spark, rows)).orderBy("key")
    got = [(r.n if r.n is None else float(r.n), r.s, r.o and (r.o.a, r.o.b), r._rescued) for r in out.collect()]
    assert got == [(1.0, "x", None, {"key": "kept"}), (2.5, None, (1, None), {}), (None, None, None, {}), (None, None, None, None), (None, "1", (3, [1]), {})]


def test_bounds_and_empty(spark):
    assert growth.grown(rescued(spark, [None, {}])).columns == ["key", "topic", "_rescued"]
    with pytest.raises(ValueError, match="columns"):
        growth.with_members(rescued(spark, [{}]), {f"m{i}": "STRING" for i in range(201)})
    plan = growth.member_types(rescued(spark, [{"a": "1"}]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_schema_of_variant_agg" in plan  # merged before the shuffle
    assert growth.member_types(rescued(spark, [{"a": "1"}]).where(F.lit(False))).count() == 0
