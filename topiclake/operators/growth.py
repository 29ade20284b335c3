"""Columns out of rescued members: each unknown member gets the least type that holds all its values, and becomes a typed column.

Types form a lattice: BIGINT < DECIMAL < DOUBLE, objects and arrays by their members, and STRING above whatever does not fit together.
``schema_of_variant_agg`` merges them as an aggregate, partial before final, so the type doesn't depend on the
order or the split of the rows, and more rows can only move it up.  A whole number among decimals counts as one of twenty
digits, so the type holds any that may still come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.functions.envelope import RESCUED

# Members that become columns at most; the rest stay in the rescued map.
MOST_COLUMNS = 200
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def _as_json(text):
    """A rescued value as a variant: numbers, objects, arrays and booleans are themselves, any other text is a string.

    The rescued map holds strings without their quotes, so a string that reads as a number counts as one.
    """
    plain = text.rlike(_NUMBER) | text.rlike(r"^\s*[\[{]") | text.isin("true", "false")
    return F.coalesce(F.when(plain, F.try_parse_json(text)), F.try_parse_json(F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2)))


def member_types(rows: DataFrame, by: str = "topic", rescued: str = RESCUED) -> DataFrame:
    """(``by``, member, type, n): type of every rescued member over all its values, as a DDL string, and how many it has."""
    each = rows.select(by, F.explode(rescued).alias("member", "text")).where("text IS NOT NULL")
    found = each.groupBy(by, "member").agg(F.schema_of_variant_agg(_as_json(F.col("text"))).alias("type"), F.count(F.lit(1)).alias("n"))
    # Objects are structs; what does not fit together, and what was never seen, is text.
    ddl = F.regexp_replace(F.regexp_replace(F.col("type"), "OBJECT<>|VARIANT|VOID", "STRING"), "OBJECT<", "STRUCT<")
    return found.withColumn("type", ddl)


def with_members(rows: DataFrame, types: dict[str, str], rescued: str = RESCUED) -> DataFrame:
    """``rows`` with a typed column per member of ``types`` (null where a row lacks it), and what is left in the rescued map.

    A member named like a column of ``rows`` stays in the map.
    """
    taken = {c.lower() for c in rows.columns}
    types = {m: t for m, t in types.items() if m.lower() not in taken}
    if len(types) > MOST_COLUMNS:
        raise ValueError(f"{len(types)} members would become columns; {MOST_COLUMNS} may")
    text = {m: F.col(rescued)[m] for m in types}
    new = {m: text[m] if t == "STRING" else F.try_variant_get(_as_json(text[m]), "$", t) for m, t in types.items()}
    left = F.map_filter(rescued, lambda k, _: ~k.isin(list(types))) if types else F.col(rescued)
    return rows.withColumns({**new, rescued: left})


def grown(rows: DataFrame, by: str = "topic", rescued: str = RESCUED) -> DataFrame:
    """``rows`` with all their rescued members as typed columns; a member of several topics gets one type for all of them."""
    one = member_types(rows.withColumn(by, F.lit("")), by, rescued)
    return with_members(rows, {r["member"]: r["type"] for r in one.collect()}, rescued)  # a row per member
