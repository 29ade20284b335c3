"""Bronze options: raw value, payload time, per-topic metadata, offset ranges (P6, P9, S4, D7, D9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.operators import bronze as B
from topiclake.operators import gold as G
from topiclake.plans import topics as P
from topiclake.sources import topics as T


def test_keep_raw_value_is_the_message_line(spark, sf):
    path = P.topic_path(spark, sf, "gps")
    raw = T.read_topic_text(spark, "gps", path)
    b = B.multiplex([raw], keep_raw=True)
    lines = T.read_folder_text(spark, path).select("value")
    assert b.select("value").exceptAll(lines).count() == 0
    assert b.where(~F.col("value").startswith('{"data":')).count() == 0
    # Default: the record without its envelope.
    d = B.multiplex([P.parsed_topic(spark, sf, "gps")])
    assert d.where(F.col("value").startswith('{"_sequence_id":')).count() == 1500


def test_time_from_key_and_payload(spark, sf):
    parsed = P.parsed_topic(spark, sf, "orders")
    by_key = B.bronze_rows(parsed, time_from="key").where("key = 7").first()
    assert by_key.timestamp.strftime("%Y-%m-%d %H:%M:%S") == "1970-01-01 00:00:07"
    by_payload = B.bronze_rows(parsed, time_from="payload").where("key = 7").first()
    want = parsed.where("data._sequence_id = 7").first().data.dt_current_timestamp
    assert by_payload.timestamp.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3] == want


def test_per_topic_schema_and_offset_ranges(spark, sf):
    t = P.per_topic_table(spark, sf, "orders")
    assert t.columns == B.PER_TOPIC_COLUMNS
    assert t.where("timestampType <> 0").count() == 0
    start = {0: 10, 1: 10, 2: 10}
    end = {0: 20, 1: 20, 2: 20}
    part = B.read_offset_range(t, "kafka-orders", start, end)
    assert part.count() == 30
    assert part.agg(F.min("offset"), F.max("offset")).first() == (10, 19)
    # A partition that the map does not name is whole.
    assert B.read_offset_range(t, "kafka-orders", {0: 10}, {}).count() == 1490
    assert B.read_offset_range(t, "kafka-orders", {}, {1: 10}).where("partition <> 1").count() == t.where("partition <> 1").count()


def test_messages_of_a_key_share_a_partition(spark, sf):
    t = P.per_topic_table(spark, sf, "events")
    assert t.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0
    assert t.select("partition").distinct().count() == 3


def test_silver_drops_rows_without_payload(spark, sf):
    from topiclake.operators import silver as S

    b = P.bronze(spark, sf)
    holed = b.withColumn("value", F.when(F.col("key") % 97 == 0, F.lit(None)).otherwise(F.col("value")))
    expect = b.where("topic = 'kafka-orders'").count() - b.where("topic = 'kafka-orders' AND key % 97 = 0").count()
    out = S.orders(holed)
    assert out.count() == expect
    assert out.where("amount IS NULL").count() == 0


def test_sampled_rows_are_rows_of_bronze(spark, sf):
    b = P.bronze(spark, sf)
    keys = ["key", "topic", "partition", "offset"]
    rows = [tuple(r) for r in G.sample(b, 5).select(*keys).collect()]
    assert len(rows) == len(set(rows)) == 5
    assert set(rows) <= {tuple(r) for r in b.select(*keys).collect()}
    assert G.sample(b.limit(3), 5).count() == 3
