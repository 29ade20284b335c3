"""User-facing API over topic folders: batch and stream bronze agree; gold questions run."""

from __future__ import annotations

from topiclake import api, session
from topiclake.plans import topics as P
from topiclake.streaming import control as C


def test_api_batch_and_stream_bronze_agree(spark, sf):
    topics = {k: P.topic_path(spark, sf, k) for k in P.KINDS}
    batch_out = api.build_bronze(spark, topics, session.fresh_path(spark, "tables", "api_batch"))
    stream_out = session.fresh_path(spark, "tables", "api_stream")
    q = api.stream_bronze(spark, topics, stream_out, checkpoint=C.checkpoint_for(spark, "api"),
                          trigger="availableNow", name="api_bronze")
    C.run_to_end(q)
    cols = ["key", "topic", "value", "partition", "offset"]
    a = api.bronze(spark, batch_out).select(*cols)
    b = api.bronze(spark, stream_out).select(*cols)
    assert a.count() == 4000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    g = api.gold(spark, batch_out)
    assert {r.topic: r["count"] for r in g["count_by_topic"].collect()} == {
        "kafka-events": 1000, "kafka-gps": 1500, "kafka-orders": 1500}
    assert g["event_sequence"].count() == 1000
    assert api.silver(spark, batch_out, "orders").count() == 1500


def test_api_keep_raw(spark, sf):
    topics = {"gps": P.topic_path(spark, sf, "gps")}
    out = api.build_bronze(spark, topics, session.fresh_path(spark, "tables", "api_raw"), keep_raw=True)
    assert api.bronze(spark, out).where("value LIKE '{\"data\":%'").count() == 1500


def test_silver_over_every_form_of_value(spark, sf):
    topics = {k: P.topic_path(spark, sf, k) for k in P.KINDS}
    raw = api.build_bronze(spark, topics, session.fresh_path(spark, "tables", "api_forms"), keep_raw=True)
    assert api.silver(spark, raw, "orders", form="message").where("payment_id IS NOT NULL").count() == 1500
    per_topic = P.per_topic_path(spark, sf, "events")
    assert api.silver(spark, per_topic, "events").where("event_name IS NOT NULL").count() == 1000


def test_rescue_in_bronze_and_named_stream(spark):
    path = session.fresh_path(spark, "topics", "api_rescue")
    lines = ['{"data":{"_sequence_id":1,"gps_id":"g1","lat":1.5,"extra":"zz"}}', "{bad"]
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(path)
    out = api.build_bronze(spark, {"gps": path}, session.fresh_path(spark, "tables", "api_rescued"), rescue_unknown=True)
    rows = {r["_corrupt_record"]: r for r in api.bronze(spark, out).collect()}
    assert rows[None]["_rescued"] == {"extra": "zz"} and rows["{bad"]["value"] == "{bad"
    streamed, name = session.fresh_path(spark, "tables", "api_named"), "bronze.api_named_stream"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for tag in "ab":
        q = api.stream_bronze(spark, {"gps": path}, streamed, checkpoint=C.checkpoint_for(spark, f"api_{tag}"), trigger="availableNow",
                              name=f"api_named_{tag}", table=name, rescue_unknown=True, max_files_per_trigger=1)
        C.run_to_end(q)
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == (2 if tag == "a" else 4)
    from topiclake.streaming import bronze_stream as BS

    assert BS.read_bronze(spark, streamed, merge_schema=True).where("_rescued IS NOT NULL").count() == 2


def test_pattern_offsets_compaction_and_typed_columns(spark):
    root, out = session.fresh_path(spark, "topics", "api_pattern"), session.fresh_path(spark, "tables", "api_pattern")
    lines = ['{"data":{"_sequence_id":%d,"gps_id":"g%d","lat":1.5}}' % (i, i) for i in range(12)]
    for topic in ("kafka-gps", "new topic+1", "skipped"):
        spark.createDataFrame([(x,) for x in [*lines, "{bad"]], "value STRING").repartition(4).write.text(f"{root}/{topic}")
    q = api.stream_bronze_pattern(spark, root, "kafka-.*|new.*", out, C.checkpoint_for(spark, "api_pattern"), trigger="availableNow", max_files_per_trigger=2)
    C.run_to_end(q)
    rows = api.bronze(spark, out)
    assert {(r.topic, r.n) for r in rows.groupBy("topic").count().withColumnRenamed("count", "n").collect()} == {("kafka-gps", 13), ("new topic+1", 13)}
    assert rows.where("topic = 'kafka-gps' AND key IS NULL").select("value").collect()[0].value == "{bad"
    assert rows.where("topic = 'new topic+1' AND key IS NULL").count() == 13  # whole lines of a topic that nobody knows
    part = api.read_offsets(spark, out, "new topic+1", {0: 3}, {0: 9})
    assert sorted(r.offset for r in part.collect()) == [3, 4, 5, 6, 7, 8]
    assert api.compact(spark, out) > 0 and api.bronze(spark, out).count() == 26
    assert sorted(r.offset for r in api.read_offsets(spark, out, "new topic+1", {0: 3}, {0: 9}).collect()) == [3, 4, 5, 6, 7, 8]
    extra = session.fresh_path(spark, "topics", "api_typed")
    lines = ['{"data":{"_sequence_id":1,"gps_id":"g1","extra":%s}}' % x for x in ("1", "2.5")]
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(extra)
    grown = api.typed_bronze(spark, api.build_bronze(spark, {"gps": extra}, session.fresh_path(spark, "tables", "api_grown"), rescue_unknown=True))
    assert sorted(float(r.extra) for r in grown.collect()) == [1.0, 2.5]
