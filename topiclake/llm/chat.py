"""Tool-call linking: calls and results joined by identifier, ordered, validated and written as canonical JSON.

Calls and results are first reduced to one row per (conversation, identifier),
each by a map-side combined aggregate, so neither side of the hash join can hold a frequent
key.  A call may wait for any number of other calls of its conversation; what it waits for are rows, so a
call that waits for very many is no long value.  Its depth is the longest path to it.  A conversation of up to ``WAITS`` waits is
ordered in one task, each call taken once all that it waits for is.  Longer ones are ordered all at once by joins:
runs of calls that wait for one other call each are crossed by pointer doubling (a round doubles the distance every call has looked
ahead, so a chain of n calls takes log2 n joins), and the calls that wait for several take a round of joins per level of
such calls, each the maximum over what it waits for once all of that is known.  So no conversation without bound is gathered in one task.  The
result has one row per call or orphan result, written in the order conversation, depth, turn,
identifier by a range exchange.  Arguments are validated row by row against the tool's schema.

Edge cases: a call without result is ``unanswered``, a result without call an
``orphan``; of repeated calls or results with one identifier the first by turn
(then by text) counts, and their number is kept.  Waiting for a call that is not there is
waiting for none; calls in or behind a cycle have a null depth.  Null identifiers link with
nothing and keep a row each.  Arguments that are null or no JSON object are errors, as is a tool without schema.  Very long texts and
arguments are taken whole; empty tables give no row; columns beyond the named ones are ignored.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut

# Waits up to which a conversation is ordered in one task.
WAITS = 100_000
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    """JSON with sorted keys, no spaces and no escapes beyond the needed ones; integral numbers without fraction."""
    def plain(v: object) -> object:
        if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parsed(text: str | None) -> object:
    """The JSON value, refusing NaN and infinities; ValueError if there is none."""
    def refuse(name: str) -> float:
        raise ValueError(name)

    def number(text: str) -> float:
        if not math.isfinite(x := float(text)):
            raise ValueError(text)
        return x

    try:
        return json.loads(text or "", parse_constant=refuse, parse_float=number)
    except RecursionError as error:
        raise ValueError("nested too deeply") from error


def violations(value: object, schema: dict, at: str = "$") -> Iterator[str]:
    """What in ``value`` breaks the schema: type, enum, bounds, lengths, required, properties, items."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = kind is None or (number and (kind == "number" or (kind == "integer" and float(value).is_integer()))) or (kind in _TYPES and isinstance(value, _TYPES[kind]))
    if not fits:
        yield f"{at}: not of type {kind}"
        return
    if "enum" in schema and value not in schema["enum"]:
        yield f"{at}: not in enum"
    if number and "minimum" in schema and value < schema["minimum"]:
        yield f"{at}: under minimum"
    if number and "maximum" in schema and value > schema["maximum"]:
        yield f"{at}: over maximum"
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if len(value) < schema.get(low, 0):
            yield f"{at}: under {low}"
        if len(value) > schema.get(high, len(value)):
            yield f"{at}: over {high}"
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            yield from violations(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                yield f"{at}.{name}: missing"
        for name, x in value.items():
            if name in own:
                yield from violations(x, own[name], f"{at}.{name}")
            elif schema.get("additionalProperties", True) is False:
                yield f"{at}.{name}: not allowed"


def depths(calls: DataFrame, waits: DataFrame, most: int = WAITS) -> DataFrame:
    """(conv_id, call_id, depth) of distinct ``calls``: the longest chain of calls that come before, by ``waits`` (conv_id, call_id, after).

    Null in or behind a cycle.
    """
    keys = ["conv_id", "call_id"]
    here = calls.select(*keys)
    there = here.withColumnRenamed("call_id", "after")
    edges = cut(waits.select(*keys, "after").distinct().join(here, keys, "left_semi").join(there, ["conv_id", "after"], "left_semi"))
    long = cut(edges.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > most).select("conv_id"))
    free = here.join(edges.select(*keys).distinct(), keys, "left_anti").withColumn("depth", F.lit(0).cast("long"))  # wait for nothing that is there
    if long.isEmpty():
        return _ordered(edges).unionByName(free)
    short = _ordered(edges.join(long, "conv_id", "left_anti")).unionByName(free.join(long, "conv_id", "left_anti"))
    return short.unionByName(_joined(here.join(long, "conv_id", "left_semi"), edges.join(long, "conv_id", "left_semi")))


def _ordered(edges: DataFrame) -> DataFrame:
    """``depths`` of the calls that wait, conversation by conversation."""

    def run(t: pa.Table) -> pa.Table:
        behind: dict[str, list[str]] = {}
        left: dict[str, int] = {}
        for call, after in zip(t.column("call_id").to_pylist(), t.column("after").to_pylist(), strict=True):
            behind.setdefault(after, []).append(call)
            left[call] = left.get(call, 0) + 1
        depth = dict.fromkeys(left)
        ready = [(a, 0) for a in behind if a not in left]
        level: dict[str, int] = {}
        while ready:
            call, d = ready.pop()
            for other in behind.get(call, ()):
                level[other] = max(level.get(other, 0), d + 1)
                left[other] -= 1
                if not left[other]:
                    depth[other] = level[other]
                    ready.append((other, level[other]))
        return pa.table({"conv_id": pa.array([t.column("conv_id")[0].as_py()] * len(depth), pa.string()), "call_id": pa.array(list(depth), pa.string()), "depth": pa.array(list(depth.values()), pa.int64())})

    return edges.groupBy("conv_id").applyInArrow(run, "conv_id string, call_id string, depth long")


def _joined(here: DataFrame, edges: DataFrame) -> DataFrame:
    """``depths`` of conversations of any length, by joins."""
    keys = ["conv_id", "call_id"]
    edges = cut(edges)
    degree = edges.groupBy(*keys).agg(F.count("*").alias("n"), F.min("after").alias("after"))
    # Calls that wait for one other point at it, the others (none, or several) at nothing: after the rounds each knows the first such call before it.
    p = here.join(degree, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") == 1, F.col("after")).alias("ptr"))
    p = cut(p.select(*keys, "n", "ptr", F.col("call_id").alias("root"), F.lit(0).cast("long").alias("dist")).withColumns(
        {"root": F.coalesce("ptr", "root"), "dist": F.when(F.col("ptr").isNotNull(), 1).otherwise(0).cast("long")}))
    rounds = 2 + max(1, p.count()).bit_length()
    while rounds and not p.where("ptr is not null").isEmpty():
        rounds -= 1
        b = p.select("conv_id", F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("root").alias("to"), F.col("dist").alias("more"))
        p = cut(p.where("ptr is not null").join(b, ["conv_id", "ptr"]).select(*keys, "n", F.col("next").alias("ptr"), F.col("to").alias("root"), (F.col("dist") + F.col("more")).alias("dist"))
                .unionByName(p.where("ptr is null")))
    known = p.where("ptr is null AND n = 0").select(*keys, F.lit(0).cast("long").alias("depth"))
    # Calls that wait for several: edges to the roots of what they wait for.
    ways = p.where("ptr is null").select("conv_id", F.col("call_id").alias("after"), "root", (F.col("dist") + 1).alias("far"))
    many = p.where("ptr is null AND n > 1").select(*keys, "n")
    left = cut(edges.join(many, keys).join(ways, ["conv_id", "after"], "left").select(*keys, "n", "root", "far"))
    while not left.isEmpty():
        at = known.select("conv_id", F.col("call_id").alias("root"), "depth")
        found = left.join(at, ["conv_id", "root"]).groupBy(*keys, "n").agg(F.count("*").alias("have"), F.max(F.col("depth") + F.col("far")).alias("depth"))
        new = cut(found.where("have = n").select(*keys, "depth"))
        if new.isEmpty():
            break  # what is left is in or behind a cycle
        known = cut(known.unionByName(new))
        left = cut(left.join(new.select(*keys), keys, "left_anti"))
    at = known.select("conv_id", F.col("call_id").alias("root"), "depth")
    out = p.join(at, ["conv_id", "root"], "left")
    return out.select(*keys, F.when(F.col("ptr").isNull(), F.col("depth") + F.col("dist")).alias("depth"))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame, waits: DataFrame | None = None) -> DataFrame:
    """Links ``calls`` (conv_id, call_id, turn, name, arguments, after) with ``results`` (conv_id, call_id, turn, content).

    ``after`` is the one call that a call waits for; ``waits`` (conv_id, call_id, after) has a row for each further one.
    ``schemas`` has (name, schema) as JSON text.  Returned: conv_id, call_id,
    turn, depth, status, n_calls, n_results, errors, json.
    """
    keys = ["conv_id", "call_id"]
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one_call = cut(calls.where(whole).groupBy(*keys).agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c"), F.count("*").alias("n_calls"))
                   .select(*keys, F.col("c.turn").alias("turn"), "c.name", "c.arguments", "c.after", "n_calls"))
    one_result = results.where(whole).groupBy(*keys).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    one_result = one_result.select(*keys, F.col("r.turn").alias("result_turn"), "r.content", "n_results")
    nothing = [F.lit(0).cast("long").alias("depth")]
    edges = one_call.where("after IS NOT NULL").select(*keys, "after")
    edges = edges if waits is None else edges.unionByName(waits.where(whole & F.col("after").isNotNull()).select(*keys, "after"))
    j = one_call.join(depths(one_call, edges), keys, "left").join(one_result, keys, "full")
    lone_call = calls.where(~whole).select(*keys, "turn", "name", "arguments", "after", F.lit(1).cast("long").alias("n_calls"), *nothing)
    lone_result = results.where(~whole).select(*keys, F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("n_results"))
    j = j.unionByName(lone_call, allowMissingColumns=True).unionByName(lone_result, allowMissingColumns=True)
    j = j.withColumns({"n_calls": F.coalesce("n_calls", F.lit(0)), "n_results": F.coalesce("n_results", F.lit(0))})
    tools = schemas.groupBy("name").agg(F.min("schema").alias("schema"))
    j = j.join(tools, "name", "left")
    status = F.when(F.col("n_calls") == 0, "orphan").when(F.col("n_results") == 0, "unanswered").otherwise("linked")
    j = j.select("conv_id", "call_id", F.coalesce("turn", "result_turn").alias("turn"), "depth", status.alias("status"), "n_calls", "n_results", "name", "arguments", "after", "content", "schema")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, dict] = {}
        for b in batches:
            errors, out = [], []
            for r in b.to_pylist():
                own, arguments = [], None
                if r["n_calls"]:
                    try:
                        arguments = parsed(r["arguments"])
                        if not isinstance(arguments, dict):
                            own.append("$: not an object")
                        elif r["schema"] is None:
                            own.append("$: no schema")
                        else:
                            if r["schema"] not in read:
                                read[r["schema"]] = json.loads(r["schema"])
                            own += violations(arguments, read[r["schema"]])
                    except ValueError:
                        own.append("$: no JSON")
                value = {"id": r["call_id"], "status": r["status"]}
                if r["n_calls"]:
                    value |= {"name": r["name"], "arguments": arguments, "after": r["after"]}
                if r["n_results"]:
                    value["result"] = r["content"]
                errors.append(own)
                out.append(canonical(value))
            keep = b.select(["conv_id", "call_id", "turn", "depth", "status", "n_calls", "n_results"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(errors, pa.list_(pa.string())), pa.array(out, pa.string())], [*keep.schema.names, "errors", "json"])

    made = j.mapInArrow(run, "conv_id string, call_id string, turn long, depth long, status string, n_calls long, n_results long, errors array<string>, json string")
    order = [F.col("conv_id"), F.col("depth").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("call_id")]
    return made.repartitionByRange(*order).sortWithinPartitions(*order)


# The tools that the derived calls name, and what their arguments have to be.
SCHEMAS = {
    "search": '{"type":"object","required":["query","chars"],"properties":{"query":{"type":"string","minLength":1},"chars":{"type":"integer","maximum":300},"turn":{"type":"integer"}},"additionalProperties":false}',
    "lookup": '{"type":"object","required":["query"],"properties":{"query":{"type":"string","maxLength":200},"turn":{"type":"integer","minimum":1}}}',
}


def derived(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and further waits out of a table that has none.

    Every user turn is a call whose arguments are its text, length and turn;
    every assistant turn is the result of the turn before.  In even conversations a
    call waits for the one two turns before, in odd ones for the one two turns after; in even ones also for
    the one four turns before.
    """
    c = conversations.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    step = F.when(F.col("conv_id").cast("long") % 2 == 0, -2).otherwise(2)
    arguments = F.concat(F.lit('{ "turn" : '), F.col("turn").cast("string"), F.lit(' , "query" : '), quoted("text"), F.lit(' , "chars" : '), F.length("text").cast("string"), F.lit("}"))
    calls = c.where("role = 'user'").select("conv_id", F.concat_ws("-", "conv_id", "turn").alias("call_id"), "turn", F.when(F.col("turn") % 2 == 0, "search").otherwise("lookup").alias("name"),
                                            arguments.alias("arguments"), F.concat_ws("-", "conv_id", F.col("turn") + step).alias("after"))
    results = c.where("role = 'assistant'").select("conv_id", F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    waits = calls.where(F.col("conv_id").cast("long") % 2 == 0).select("conv_id", "call_id", F.concat_ws("-", "conv_id", F.col("turn") - 4).alias("after"))
    return calls, results, waits


def quoted(col: str):
    """A text as a JSON string."""
    one = F.to_json(F.struct(F.col(col).alias("t")))
    return F.substr(one, F.lit(6), F.length(one) - 6)


def digest(conversations: DataFrame) -> DataFrame:
    """One row per call or orphan result of the derived calls; the JSON as SHA-256."""
    spark: SparkSession = conversations.sparkSession
    calls, results, waits = derived(conversations)
    out = linked(calls, results, spark.createDataFrame(list(SCHEMAS.items()), "name string, schema string"), waits)
    return out.select("conv_id", "call_id", "turn", "depth", "status", "n_calls", "n_results", F.size("errors").alias("n_errors"), F.sha2("json", 256).alias("json_sha256"))


#: The same in DuckDB for the derived calls, whose chains are known.
ORACLE = """
WITH c AS (SELECT conv_id::VARCHAR AS conv_id, conv_id AS n, turn::BIGINT AS turn, role, coalesce(text, '') AS text FROM conversations),
k AS (SELECT conv_id, n, conv_id || '-' || turn AS call_id, turn, CASE WHEN turn % 2 = 0 THEN 'search' ELSE 'lookup' END AS name, text, length(text) AS chars,
        conv_id || '-' || (turn + CASE WHEN n % 2 = 0 THEN -2 ELSE 2 END) AS after FROM c WHERE role = 'user'),
b AS (SELECT *, CASE WHEN turn - lag(turn) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) <= CASE WHEN n % 2 = 0 THEN 4 ELSE 2 END THEN 0 ELSE 1 END AS opens FROM k),
g AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM b),
d AS (SELECT *, CASE WHEN n % 2 = 0 THEN row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) ELSE row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn DESC) END - 1 AS depth FROM g),
r AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn AS rturn, text AS content FROM c WHERE role = 'assistant'),
j AS (SELECT coalesce(d.conv_id, r.conv_id) AS conv_id, coalesce(d.call_id, r.call_id) AS call_id, coalesce(turn, rturn) AS turn, depth, d.call_id IS NOT NULL AS has_call, r.call_id IS NOT NULL AS has_result, name, text, chars, after, content
      FROM d FULL JOIN r ON d.conv_id = r.conv_id AND d.call_id = r.call_id),
s AS (SELECT *, CASE WHEN NOT has_call THEN 'orphan' WHEN NOT has_result THEN 'unanswered' ELSE 'linked' END AS status FROM j)
SELECT conv_id, call_id, turn, depth, status, has_call::INT::BIGINT AS n_calls, has_result::INT::BIGINT AS n_results,
  CASE WHEN NOT has_call THEN 0 WHEN name = 'search' THEN (chars < 1)::INT + (chars > 300)::INT ELSE (chars > 200)::INT + (turn < 1)::INT END AS n_errors,
  sha256('{' || CASE WHEN has_call THEN '"after":' || to_json(after)::VARCHAR || ',"arguments":{"chars":' || chars || ',"query":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},' ELSE '' END
    || '"id":' || to_json(call_id)::VARCHAR || CASE WHEN has_call THEN ',"name":' || to_json(name)::VARCHAR ELSE '' END
    || CASE WHEN has_result THEN ',"result":' || to_json(content)::VARCHAR ELSE '' END || ',"status":' || to_json(status)::VARCHAR || '}') AS json_sha256 FROM s
"""
