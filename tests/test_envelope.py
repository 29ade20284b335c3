"""Parse / serialise / rescue edge cases (FIXTURES §4)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from topiclake.functions.envelope import CORRUPT, parse, rescue, serialise
from topiclake.schemas import ddl, envelope, gps_data, order_data


def _text(spark, values):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField("value", StringType())]))


def test_broken_json_gives_nulls_and_corrupt_record(spark):
    df = _text(spark, ["{bad"])
    schema = envelope("orders", corrupt_column=CORRUPT)
    row = df.select(parse("value", schema, corrupt=True).alias("m")).first()["m"]
    assert row["data"] is None
    assert row[CORRUPT] == "{bad"


def test_one_bad_field_is_null_others_kept(spark):
    df = _text(spark, ['{"a":"q","b":1}'])
    schema = StructType.fromDDL("a INT, b INT, _corrupt_record STRING")
    row = df.select(parse("value", schema, corrupt=True).alias("m")).first()["m"]
    assert row["a"] is None and row["b"] == 1
    assert row[CORRUPT] == '{"a":"q","b":1}'


def test_null_value_gives_null_struct(spark):
    df = _text(spark, [None])
    assert df.select(parse("value", envelope("orders")).alias("m")).first()["m"] is None


def test_flat_schema_on_envelope_is_all_null(spark):
    msg = json.dumps({"data": {"lat": -23.55, "lon": -46.63, "gps_id": "g"}})
    flat = StructType.fromDDL("latitude DOUBLE, longitude DOUBLE, device_id STRING")
    row = _text(spark, [msg]).select(parse("value", flat).alias("m")).first()["m"]
    assert row["latitude"] is None and row["device_id"] is None
    ok = _text(spark, [msg]).select(parse("value", envelope("gps")).alias("m")).first()["m"]
    assert ok["data"]["lat"] == -23.55


def test_ddl_schema_parses_like_struct(spark):
    msg = json.dumps({"_sequence_id": 3, "amount": 12.5, "status": "pending"})
    df = _text(spark, [msg])
    a = df.select(parse("value", order_data()).alias("r")).first()["r"]
    b = df.select(parse("value", ddl(order_data())).alias("r")).first()["r"]
    assert a == b and a["amount"] == 12.5 and a["_sequence_id"] == 3


def test_unknown_field_rescued_and_dropped_on_serialise(spark):
    msg = json.dumps({"data": {"gps_id": "g1", "lat": 1.5, "extra": "zz", "nested": {"x": 1}}})
    df = _text(spark, [msg])
    out = df.select(
        parse("value", envelope("gps")).getField("data").alias("d"),
        rescue("value", gps_data()).alias("r"),
    ).select(serialise("d").alias("j"), "r").first()
    assert out["r"]["extra"] == "zz"
    assert json.loads(out["r"]["nested"]) == {"x": 1}
    assert "extra" not in json.loads(out["j"])


def test_null_member_dropped_unless_kept(spark):
    df = spark.createDataFrame([("a", None)], "x STRING, nul STRING").select(F.struct("x", "nul").alias("s"))
    assert json.loads(df.select(serialise("s").alias("j")).first()["j"]) == {"x": "a"}
    assert json.loads(df.select(serialise("s", keep_nulls=True).alias("j")).first()["j"]) == {"x": "a", "nul": None}


def test_roundtrip_without_nulls(spark, sf):
    from topiclake.functions.envelope import message_text
    from topiclake.sources.fixtures import records

    rec = records(spark, sf, "gps")
    back = rec.select(message_text(F.col("data")).alias("value")).select(
        parse("value", envelope("gps")).getField("data").alias("data"))
    assert rec.exceptAll(back).count() == 0 and back.exceptAll(rec).count() == 0


def test_malformed_event_time_is_null_not_an_error(spark):
    from topiclake.functions.payload import parse_event_time

    df = _text(spark, ["2024-01-02 03:04:05.678", "yesterday", None])
    got = [r.t for r in df.select(parse_event_time("value").alias("t")).collect()]
    assert got[0].strftime("%Y-%m-%d %H:%M:%S.%f") == "2024-01-02 03:04:05.678000"
    assert got[1] is None and got[2] is None
