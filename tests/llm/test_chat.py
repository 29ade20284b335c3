"""op4: links, order, validation and canonical JSON."""

from __future__ import annotations

import json

import pytest

from topiclake.llm import chat

CALLS = "conv_id string, call_id string, turn long, name string, arguments string, after string"
RESULTS = "conv_id string, call_id string, turn long, content string"
SCHEMA = json.dumps({"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"enum": ["x", 2]}, "c": {"type": "array", "items": {"type": "string", "maxLength": 2}}}, "additionalProperties": False})


def linked(spark, calls, results, schemas=(("f", SCHEMA),)):
    out = chat.linked(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), spark.createDataFrame(list(schemas), "name string, schema string"))
    return out.collect()


def test_statuses_duplicates_and_nulls(spark):
    calls = [("c", "1", 1, "f", '{"a":1}', None), ("c", "1", 3, "f", '{"a":2}', None), ("c", "2", 2, "f", '{"b" : "x", "a":2.0}', "1"), ("c", None, 4, "f", None, None), ("d", "1", 1, "g", "[]", "9"), (None, "7", None, "f", "{", "7")]
    results = [("c", "1", 2, "r"), ("c", "1", 2, "r"), ("c", "9", 5, "lost"), (None, "7", 1, "n")]
    rows = linked(spark, calls, results)
    got = {(r.conv_id, r.call_id, r.status): (r.n_calls, r.n_results, r.depth, len(r.errors)) for r in rows}
    assert len(rows) == 7 and got == {
        ("c", "1", "linked"): (2, 2, 0, 0), ("c", "2", "unanswered"): (1, 0, 1, 0), ("c", None, "unanswered"): (1, 0, 0, 1),
        ("c", "9", "orphan"): (0, 1, None, 0), ("d", "1", "unanswered"): (1, 0, 0, 1), (None, "7", "unanswered"): (1, 0, 0, 1), (None, "7", "orphan"): (0, 1, None, 0)}
    assert {r.json for r in rows if r.call_id == "2"} == {'{"after":"1","arguments":{"a":2,"b":"x"},"id":"2","name":"f","status":"unanswered"}'}


def test_order_of_chains_and_cycles(spark):
    n = 70
    calls = [("long", f"{i}", n - i, "f", '{"a":1}', f"{i - 1}" if i else None) for i in range(n)]
    calls += [("ring", "a", 1, "f", '{"a":1}', "b"), ("ring", "b", 2, "f", '{"a":1}', "a"), ("ring", "c", 3, "f", '{"a":1}', "a"), ("ring", "d", 4, "f", '{"a":1}', None), ("self", "s", 1, "f", '{"a":1}', "s")]
    rows = linked(spark, calls, [])
    depth = {(r.conv_id, r.call_id): r.depth for r in rows}
    assert all(depth["long", f"{i}"] == i for i in range(n))
    assert [depth["ring", x] for x in "abcd"] == [None, None, None, 0] and depth["self", "s"] is None
    own = [r.call_id for r in rows if r.conv_id == "long"]
    assert own == [f"{i}" for i in range(n)]


def longest(calls, waits):
    """Depth of every call by plain search; None in or behind a cycle."""
    before = {c: {a for x, a in waits if x == c and a in calls} for c in calls}
    depth, todo = {}, set(calls)
    while ready := [c for c in todo if before[c] <= depth.keys()]:
        for c in ready:
            depth[c] = max((depth[a] + 1 for a in before[c]), default=0)
        todo -= set(ready)
    return depth | dict.fromkeys(todo)


@pytest.mark.parametrize("seed,most", [(0, 0), (1, 40), (2, 10**6), (3, 40)])
def test_order_of_any_graph(spark, seed, most):
    """Diamonds, chains into and out of them, cycles, calls that wait for absent ones."""
    import random

    rng = random.Random(seed)
    names = [f"n{i}" for i in range(40)]
    waits = [(b, a) for i, b in enumerate(names) for a in rng.sample(names[:i], min(i, rng.choice([0, 1, 1, 1, 2, 3])))]
    waits += [("top", "left"), ("top", "right"), ("left", "base"), ("right", "mid"), ("mid", "base"), ("base", "absent"), ("n5", "n5"), ("n7", "n9"), ("n9", "n7"), ("top", "left")]
    names += ["top", "left", "right", "mid", "base"]
    calls = spark.createDataFrame([("c", n) for n in names] + [("d", n) for n in names[:20]], "conv_id string, call_id string")
    rows = [("c", *w) for w in waits] + [("d", b, a) for b, a in waits if b not in ("n5", "n7", "n9")]
    got = {(r.conv_id, r.call_id): r.depth for r in chat.depths(calls, spark.createDataFrame(rows, "conv_id string, call_id string, after string"), most).collect()}
    want = {("c", n): d for n, d in longest(names, waits).items()}
    want |= {("d", n): d for n, d in longest(names[:20], [w for w in waits if w[0] not in ("n5", "n7", "n9")]).items()}
    assert got == want and want["c", "top"] == 3 and None in want.values()


def test_long_chain_of_calls_that_wait_for_two(spark):
    """A level for each of 3,000 calls, in one task."""
    n = 3000
    calls = spark.range(n).selectExpr("'c' AS conv_id", "CAST(id AS STRING) AS call_id")
    waits = spark.range(n).selectExpr("'c' AS conv_id", "CAST(id AS STRING) AS call_id", "explode(array(CAST(id - 1 AS STRING), CAST(id - 2 AS STRING))) AS after")
    assert {int(r.call_id): r.depth for r in chat.depths(calls, waits).collect()} == {i: i for i in range(n)}


def test_further_waits_and_extra_columns(spark):
    calls = [("c", "1", 1, "f", '{"a":1}', None), ("c", "2", 2, "f", '{"a":1}', "1"), ("c", "3", 3, "f", '{"a":1}', "1"), ("c", "4", 4, "f", '{"a":1,"b":"' + "x" * 300_000 + '"}', "2")]
    df = spark.createDataFrame([(*c, "n", 5) for c in calls], CALLS + ", content string, depth int")
    waits = spark.createDataFrame([("c", "4", "3"), ("c", "3", "2"), ("c", None, "1"), ("c", "4", None)], "conv_id string, call_id string, after string")
    results = spark.createDataFrame([("c", "4", 5, "é" * 100_000, "clash")], RESULTS + ", name string")
    rows = chat.linked(df, results, spark.createDataFrame([("f", SCHEMA)], "name string, schema string"), waits).collect()
    assert {r.call_id: r.depth for r in rows} == {"1": 0, "2": 1, "3": 2, "4": 3}
    assert [r.call_id for r in rows] == ["1", "2", "3", "4"] and len(rows[3].json) > 400_000 and len(rows[3].errors) == 1


@pytest.mark.parametrize("text,errors", [('{"a":1}', 0), ('{"a":0}', 1), ('{"a":1.5}', 1), ('{"a":true}', 1), ("{}", 1), ('{"a":1,"z":1}', 1), ('{"a":1,"b":"y"}', 1), ('{"a":1,"c":["xy","xyz",1]}', 2), ('{"a":NaN}', None), ('{"a":1e999}', None), ("[" * 100_000, None)])
def test_validation(text, errors):
    if errors is None:
        with pytest.raises(ValueError):
            chat.parsed(text)
    else:
        assert len(list(chat.violations(chat.parsed(text), json.loads(SCHEMA)))) == errors


def test_canonical():
    assert chat.canonical(json.loads('{ "b":[1.0, 2.5,{"é":null}], "a":"x\\u0001/" }')) == '{"a":"x\\u0001/","b":[1,2.5,{"é":null}]}'


def test_empty_and_null_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", None), (1, 1, "assistant", None), (None, 2, "user", "q"), (2, None, "user", "q"), (1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    assert chat.digest(rows).count() == 3
    assert chat.digest(rows.limit(0)).count() == 0
