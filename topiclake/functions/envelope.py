"""Message envelope: parse, flatten, serialise, rescue unknown fields.

A message is a JSON object ``{"data": {...}}``.  Parsing is PERMISSIVE: a
broken line gives a struct of NULLs (and the line in ``_corrupt_record`` when
that field is in the schema), a field of the wrong type is NULL while the
others are kept, and a NULL text gives a NULL struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORRUPT = "_corrupt_record"
RESCUED = "_rescued"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(value: Column | str, schema: StructType | str, corrupt: bool = False) -> Column:
    """``from_json`` (PERMISSIVE, the default) with a StructType or a DDL string.

    No options unless the corrupt-record column is asked for: Catalyst then
    prunes the parse schema to the fields a query reads.
    """
    if corrupt:
        return F.from_json(_c(value).cast("string"), schema, {"columnNameOfCorruptRecord": CORRUPT})
    return F.from_json(_c(value).cast("string"), schema)


def serialise(struct: Column | str, keep_nulls: bool = False) -> Column:
    """``to_json``; NULL members are dropped unless ``keep_nulls``."""
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(_c(struct), options)


def wrap(data: Column) -> Column:
    """Put a record struct into the envelope ``{"data": ...}``."""
    return F.struct(data.alias("data"))


def message_text(data: Column) -> Column:
    """JSON text of one message, ``{"data": {...}}``."""
    return F.to_json(wrap(data))


def flatten(df: DataFrame, struct: str, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``select(*keep, "struct.*")``."""
    return df.select(*keep, f"{struct}.*")


def rescue(value: Column | str, schema: StructType, path: str = "$.data") -> Column:
    """Members of the JSON object at ``path`` that ``schema`` does not name.

    Returned as ``map<string,string>`` (nested values as JSON text), empty when
    there is none, NULL when the object is missing or broken.
    """
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    members = F.from_json(F.get_json_object(_c(value).cast("string"), path), "map<string,string>")
    return F.map_filter(members, lambda k, v: ~F.array_contains(known, k))
