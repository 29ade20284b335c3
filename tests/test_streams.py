"""Streams: restart, replay, fresh checkpoint, empty topic, sinks, progress, Kafka options (Q*, K*, S*)."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from topiclake import session
from topiclake.plans import registry as R
from topiclake.plans import topics as P
from topiclake.schemas import envelope
from topiclake.sources import topics as T
from topiclake.streaming import bronze_stream as BS
from topiclake.streaming import control as C


def _summary(df):
    return {(r.topic, r.partition): (r.n, r.min_offset, r.max_offset, r.distinct_offsets)
            for r in df.collect()}


def test_resume_after_stop_no_loss_no_duplicate(spark, sf):
    df = R.QUERIES["stream_resume_no_duplicates"](spark, sf)
    assert df.where("not several_batches").count() == 0
    got = _summary(df)
    for (_, _), (n, lo, hi, d) in got.items():
        assert lo == 0 and hi == n - 1 and d == n
    assert sum(v[0] for v in got.values()) == 4000


def test_replayed_batch_adds_nothing(spark, sf):
    got = _summary(R.QUERIES["stream_replay_idempotent"](spark, sf))
    assert sum(v[0] for v in got.values()) == 4000
    for n, lo, hi, d in got.values():
        assert (lo, hi, d) == (0, n - 1, n)


def test_fresh_checkpoint_doubles_rows(spark, sf):
    rows = {r.topic: r for r in R.QUERIES["stream_replay_duplicates"](spark, sf).collect()}
    assert all(r.total_rows == 2 * r.distinct_keys == r.distinct_offsets for r in rows.values()) and len(rows) == 3


def _orders(spark, lo, hi, topic="kafka-orders"):
    return spark.range(lo, hi).selectExpr("id AS key", "CAST(id AS STRING) AS value", f"'{topic}' AS topic",
                                          "CAST(id % 3 AS INT) AS partition", "timestamp_seconds(id) AS timestamp")


@pytest.mark.parametrize("tag", ["1234567890123", "1234567e8901", "12345678901d", "012345678901", "1234567890"])
def test_run_tags_and_topics_that_look_like_numbers(spark, tag):
    path = session.fresh_path(spark, "tables", "numeric_tag")
    rows = _orders(spark, 0, 60, "2024").unionByName(_orders(spark, 0, 30, "2024-01-01"))
    for batch in (0, 1, 0):  # the last is a replay
        BS.BronzeBatchWriter(path, run=tag)(rows, batch)
    got = BS.read_bronze(spark, path)
    assert got.count() == 180 and {r[0] for r in got.select("_run").distinct().collect()} == {tag}
    assert {r[0] for r in got.select("topic").distinct().collect()} == {"2024", "2024-01-01"}
    assert got.select("topic", "partition", "offset").distinct().count() == 180


def test_run_tags_start_with_a_letter():
    assert all(BS.run_of(f"cp{i}")[0] == "r" for i in range(50))


def test_interleaved_runs_and_late_replays(spark):
    path = session.fresh_path(spark, "tables", "interleave")
    parts = [_orders(spark, 100 * i, 100 * i + 90) for i in range(4)]
    for run, batch, i in (("rA", 0, 0), ("rB", 0, 1), ("rA", 1, 2)):
        BS.BronzeBatchWriter(path, run=run)(parts[i], batch)
    before = sorted(map(tuple, BS.read_bronze(spark, path).select("key", "partition", "offset").collect()))
    BS.BronzeBatchWriter(path, run="rA")(parts[0], 0)  # replay of A after B
    after = sorted(map(tuple, BS.read_bronze(spark, path).select("key", "partition", "offset").collect()))
    assert before == after and len({(p, o) for _, p, o in after}) == 270
    BS.BronzeBatchWriter(path, run="rB")(parts[3], 1)
    for n, lo, hi, d in _summary(R._bronze_offsets_summary(BS.read_bronze(spark, path))).values():
        assert (lo, hi, d) == (0, n - 1, n) and n == 120


def test_second_active_writer_is_refused(spark):
    path = session.fresh_path(spark, "tables", "two_writers")
    BS.BronzeBatchWriter(path, run="rA")(_orders(spark, 0, 9), 0)
    log = BS.CommitLog(spark, path)
    session.write_text(spark, f"{log.root}/claims/1.json", '["rB", 0]', overwrite=False)  # B has claimed, not yet written
    with pytest.raises(RuntimeError, match="another writer"):
        BS.BronzeBatchWriter(path, run="rA")(_orders(spark, 9, 18), 1)
    BS.BronzeBatchWriter(path, run="rB")(_orders(spark, 9, 18), 0)
    BS.BronzeBatchWriter(path, run="rA")(_orders(spark, 18, 27), 1)
    assert sorted(r.offset for r in BS.read_bronze(spark, path).where("partition = 0").collect()) == list(range(9))


def _named(spark, batches=4):
    path = session.fresh_path(spark, "tables", "compact_named")
    name = BS.declare_table(spark, f"bronze.compact_{path[-12:]}", path)
    for b in range(batches):
        BS.BronzeBatchWriter(path, run="rx", table=name)(_orders(spark, 30 * b, 30 * b + 30).unionByName(_orders(spark, 30 * b, 30 * b + 10, "a/b c=d")), b)
    return path, name


def _both(spark, path, name):
    one = sorted(map(tuple, spark.sql(f"SELECT topic, partition, offset, key FROM {name}").collect()))
    assert one == sorted(map(tuple, BS.read_bronze(spark, path).select("topic", "partition", "offset", "key").collect()))
    return one


def test_compaction_keeps_the_named_table(spark):
    path, name = _named(spark)
    before = _both(spark, path, name)
    assert len(before) == 160
    assert BS.compact(spark, path) == 3 and _both(spark, path, name) == before
    BS.BronzeBatchWriter(path, run="rx", table=name)(_orders(spark, 500, 530), 4)
    assert BS.compact(spark, path) == 1 and len(_both(spark, path, name)) == 190
    assert BS.CommitLog(spark, path).noted() == (None, None)


@pytest.mark.parametrize("step", ["planned", "half written", "written", "swapped", "half deleted", "deleted"])
def test_compaction_that_died(spark, monkeypatch, step):
    path, name = _named(spark)
    before = _both(spark, path, name)

    class Died(Exception):
        pass

    note, forget, delete = BS.CommitLog.note, BS._forget, session.delete_matching
    if step in ("planned", "half written", "written"):
        def dies(self, at, what):
            if at == "plan" and step == "planned":
                note(self, at, what)
                raise Died
            if at == "swap":  # the merged rows are there, the swap is not
                if step == "half written":
                    delete(spark, f"{path}/topic=kafka-orders/_run={BS.COMPACTED}/_batch_id=0")
                raise Died
            note(self, at, what)
        monkeypatch.setattr(BS.CommitLog, "note", dies)
    elif step == "swapped":
        monkeypatch.setattr(BS, "_forget", lambda *a: (_ for _ in ()).throw(Died()))
    else:
        left = [1 if step == "half deleted" else 3]

        def dies(spark_, pattern):
            if not left[0]:
                raise Died
            left[0] -= 1
            delete(spark_, pattern)
        monkeypatch.setattr(session, "delete_matching", dies)
        if step == "deleted":
            monkeypatch.setattr(BS.CommitLog, "ended", lambda self: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        BS.compact(spark, path)
    read = BS.read_bronze(spark, path).select("topic", "partition", "offset", "key")
    assert sorted(map(tuple, read.collect())) == before  # readers by path never see a row twice or not at all
    monkeypatch.undo()
    BS.compact(spark, path)
    assert _both(spark, path, name) == before and BS.CommitLog(spark, path).noted() == (None, None)


def test_compaction_keeps_rows_and_last_batches(spark):
    path = session.fresh_path(spark, "tables", "compact")
    for batch in range(5):
        BS.BronzeBatchWriter(path, run="rA")(_orders(spark, 10 * batch, 10 * batch + 10), batch)
    rows = lambda: sorted(map(tuple, BS.read_bronze(spark, path).select("key", "partition", "offset", "topic").collect()))
    before = rows()
    assert BS.compact(spark, path) == 4 and rows() == before
    BS.BronzeBatchWriter(path, run="rA")(_orders(spark, 40, 50), 4)  # the last batch may still be replayed
    assert rows() == before and BS.compact(spark, path) == 0
    assert {r._run for r in BS.read_bronze(spark, path).select("_run").distinct().collect()} == {"rA", BS.COMPACTED}


def test_progress_beyond_what_a_query_holds(spark):
    folder = session.fresh_path(spark, "topics", "many_files")
    spark.range(0, 130, 1, 130).selectExpr("CAST(id AS STRING) AS value").write.text(folder)
    src = spark.readStream.option("maxFilesPerTrigger", "1").text(folder)
    log = C.ProgressLog(spark, every=40)
    q = C.start(src, "many_batches", C.checkpoint_for(spark, "many"), sink="parquet", path=session.fresh_path(spark, "streams", "many"), trigger="availableNow")
    C.run_to_end(q)
    events = log.frame([q]).where(F.col("run_id") == str(q.runId))
    log.close()
    assert events.where("num_input_rows > 0").select("batch_id").distinct().count() >= 110
    assert events.agg(F.sum("num_input_rows")).first()[0] == 130
    assert len(q.recentProgress) <= 110


def test_console_sink_and_as_fast_as_possible(spark, sf):
    src = P.parsed_topic(spark, sf, "events", mode="stream").select("data.event_id").where("event_id LIKE 'evt-1%'")
    q = C.start(src, "console_events", C.checkpoint_for(spark, "con"), sink="console", trigger="availableNow")
    C.run_to_end(q)
    assert sum(p.numInputRows for p in q.recentProgress) == 1000
    out = session.fresh_path(spark, "streams", "asap")
    q = C.start(src, "asap_events", C.checkpoint_for(spark, "asap"), sink="parquet", path=out, trigger=None)
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == src.sparkSession.read.parquet(out).distinct().count() > 0


def test_admission_options():
    assert T.admission("stream", 3) == {"maxFilesPerTrigger": "3"} and T.admission("batch", 3) == {}
    assert T.admission("stream", max_bytes_per_trigger="1g") == {"maxBytesPerTrigger": "1g"}
    with pytest.raises(ValueError):
        T.admission("stream", 1, "1g")


def test_kafka_sink_options():
    spec = T.TopicSpec(bootstrap_servers="broker:9092", client={"acks": "all"})
    assert T.kafka_sink_options(spec) == {"kafka.bootstrap.servers": "broker:9092", "kafka.acks": "all"}
    with pytest.raises(ValueError):
        T.kafka_sink_options(T.TopicSpec())


def test_empty_topic_gives_empty_bronze(spark):
    empty = tempfile.mkdtemp(prefix="empty-topic-")
    src = T.read_folder(spark, empty, envelope("orders"), "kafka-orders", mode="stream")
    path = session.fresh_path(spark, "tables", "empty_bronze")
    q = BS.start_bronze_stream([src], path, name="empty_bronze", checkpoint=C.checkpoint_for(spark, "empty"),
                               trigger="availableNow")
    C.run_to_end(q)
    assert not session.path_exists(spark, path) and BS.CommitLog(spark, path).last() is None


def test_batch_equals_stream(spark, sf):
    rows = R.QUERIES["batch_equals_stream"](spark, sf).collect()
    assert sum(r.streamed_rows for r in rows) == 4000 and all(r.differences == 0 for r in rows)


def test_console_and_memory_sinks_small(spark, sf):
    src = P.parsed_topic(spark, sf, "events", mode="stream").select("data.event_id")
    q = C.start(src, name="mem_events", checkpoint=C.checkpoint_for(spark, "mem"), sink="memory",
                trigger="availableNow")
    C.run_to_end(q)
    assert spark.table("mem_events").count() == 1000
    assert C.status(q)["name"] == "mem_events"


def test_processing_time_trigger_and_stop_all(spark, sf):
    src = P.parsed_topic(spark, sf, "gps", mode="stream").select("data.gps_id")
    out = session.fresh_path(spark, "streams", "pt")
    q = C.start(src, name="pt_gps", checkpoint=C.checkpoint_for(spark, "pt"), sink="parquet", path=out,
                trigger="1 second")
    q.processAllAvailable()
    assert "pt_gps" in C.stop_all(spark)
    assert not q.isActive
    assert spark.read.parquet(out).count() == 1500


def test_progress_rows(spark, sf):
    df = R.QUERIES["stream_progress_rows"](spark, sf)
    assert df.agg(F.sum("num_input_rows")).first()[0] == 4000


def test_kafka_option_maps():
    spec = T.TopicSpec(topics=["ordem"], bootstrap_servers="broker:9092", starting_offsets="earliest",
                       fail_on_data_loss=False, client={"session.timeout.ms": 30000})
    assert T.kafka_options(spec) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "ordem", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "kafka.session.timeout.ms": "30000"}
    many = T.kafka_options(T.TopicSpec(topics=["ordem", "eventos", "gps"]))
    assert many == {"subscribe": "ordem,eventos,gps"}  # default start: latest (stream) / earliest (batch)
    pat = T.kafka_options(T.TopicSpec(pattern="ordem|eventos|gps"), batch=True)
    assert pat == {"subscribePattern": "ordem|eventos|gps"}
    rng = T.kafka_options(T.TopicSpec(topics=["gps"], starting_offsets="earliest", ending_offsets="latest"), batch=True)
    assert rng["endingOffsets"] == "latest"


def test_await_any_and_bounded_wait(spark, sf):
    spark.streams.resetTerminated()  # queries that ended earlier would answer at once, or raise again
    src = P.parsed_topic(spark, sf, "orders", mode="stream").select("data._sequence_id")
    out = session.fresh_path(spark, "streams", "aw")
    q = C.start(src, name="await_orders", checkpoint=C.checkpoint_for(spark, "aw"), sink="parquet", path=out,
                trigger="availableNow")
    C.await_any(spark, 120)
    assert q.awaitTermination(60) is True
    spark.streams.resetTerminated()
    assert spark.read.parquet(out).count() == 1500


def test_snapshot_of_growing_table(spark, sf):
    missing = session.fresh_path(spark, "tables", "absent")
    total, sample = C.snapshot(spark, missing)
    assert total.count() == 0 and sample.count() == 0
    path = P.bronze_path(spark, sf)
    total, sample = C.snapshot(spark, path)
    assert total.first().total_rows == 4000 and sample.count() == 5


def test_create_database_idempotent_and_tables_listed(spark, sf):
    from topiclake.operators import bronze as B

    for _ in range(2):
        name = B.register(spark, "bronze", "kafka_multiplex", P.bronze_path(spark, sf))
    assert name == "bronze.kafka_multiplex"
    assert spark.table(name).count() == 4000
    names = {r.tableName for r in R.QUERIES["list_bronze_tables"](spark, sf).collect()}
    assert names == {"kafka_bronze_ordem", "kafka_bronze_eventos", "kafka_bronze_gps"}


def test_ingestion_time_set_and_constant_per_write(spark, sf):
    b = P.build_bronze(spark, sf)
    r = b.agg(F.count("ingestion_timestamp").alias("n"), F.countDistinct("ingestion_timestamp").alias("d")).first()
    assert r.n == 4000 and r.d == 1


def test_read_with_rescue_from_folder(spark, sf):
    path = session.fresh_path(spark, "topics", "rescue")
    lines = ['{"data":{"_sequence_id":1,"gps_id":"g1","lat":1.5,"extra":"zz"}}', '{bad']
    spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1).write.text(path)
    rows = {r._corrupt_record: r for r in T.read_with_rescue(spark, path, "gps").collect()}
    good = rows[None]
    assert good.data._sequence_id == 1 and good._rescued == {"extra": "zz"}
    assert rows["{bad"].data is None


def test_schema_growth_read_merges(spark, sf):
    df = R.QUERIES["bronze_schema_growth"](spark, sf)
    assert set(df.columns) == {"key", "topic", "event_name"}
    assert df.where("topic = 'kafka-orders' AND event_name IS NULL").count() == 3000
    assert df.where("event_name IS NOT NULL").count() == 1000 and df.count() == 8000


def test_watermark_drops_late_rows_of_closed_windows(spark):
    import datetime as dt

    from topiclake.operators import extensions as E

    folder = session.fresh_path(spark, "topics", "late_events")
    schema = "event_id BIGINT, ts TIMESTAMP, event_type STRING"

    def put(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")

    d = dt.datetime(2024, 1, 1)
    put([(1, d.replace(minute=5), "click"), (2, d.replace(minute=20), "click"),
         (3, d.replace(hour=1, minute=10), "click"), (4, d.replace(hour=2, minute=30), "click")], "b1")
    src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    counts = E.watermarked_counts(E.event_times(src), "1 hour", "10 minutes")
    out, cp = session.fresh_path(spark, "streams", "late"), C.checkpoint_for(spark, "late")
    C.run_to_end(C.start(counts, "late_1", cp, sink="parquet", path=out, trigger="availableNow"))
    # A row 2 hours late (its window is closed) and one that moves the watermark on.
    put([(5, d.replace(minute=30), "click"), (6, d.replace(hour=3, minute=40), "click")], "b2")
    C.run_to_end(C.start(counts, "late_2", cp, sink="parquet", path=out, trigger="availableNow"))
    got = {r.window_start: r.n for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-01 00:00:00": 2, "2024-01-01 01:00:00": 1, "2024-01-01 02:00:00": 1}


def test_stream_to_managed_table(spark, sf):
    session.ensure_database(spark, "bronze")
    src = P.parsed_topic(spark, sf, "gps", mode="stream").select("data._sequence_id", "data.order_id")
    q = C.start(src, "gps_to_table", C.checkpoint_for(spark, "tbl"), sink="table", path="bronze.gps_stream_test",
                trigger="availableNow")
    C.run_to_end(q)
    assert spark.table("bronze.gps_stream_test").count() == 1500


def test_any_micro_batch_split_gives_same_rows_and_gap_free_offsets(spark, sf):
    from topiclake.sources.fixtures import topic_messages

    folder = session.fresh_path(spark, "topics", "split_orders")
    T.write_topic_folder(topic_messages(spark, sf, "orders").repartition(7), folder)
    batch = P.build_bronze(spark, sf, kinds=("orders",)).select("key", "topic", "partition")
    for per_trigger in (1, 3):
        src = T.read_folder(spark, folder, envelope("orders"), "kafka-orders", mode="stream",
                            max_files_per_trigger=per_trigger)
        path = session.fresh_path(spark, "tables", f"split{per_trigger}")
        q = BS.start_bronze_stream([src], path, name=f"split_{per_trigger}",
                                   checkpoint=C.checkpoint_for(spark, f"split{per_trigger}"), trigger="availableNow")
        C.run_to_end(q)
        got = BS.read_bronze(spark, path)
        assert got.select("_batch_id").distinct().count() > 1
        rows = got.select("key", "topic", "partition")
        assert rows.exceptAll(batch).count() == 0 and batch.exceptAll(rows).count() == 0
        for n, lo, hi, d in _summary(R._bronze_offsets_summary(got)).values():
            assert (lo, hi, d) == (0, n - 1, n)


def test_partial_aggregates_merge_like_one_aggregate(spark, sf):
    from topiclake.operators import gold as G

    gps = P.silver(spark, sf, "gps")
    pieces = [gps.where(f"offset % 3 = {i}") for i in range(3)]  # any split of the rows
    parts = pieces[0].transform(lambda d: G.gps_partials(d, "speed_kph"))
    for p in pieces[1:]:
        parts = parts.unionByName(G.gps_partials(p, "speed_kph"))
    a = sorted(tuple(r) for r in G.merge_gps_partials(parts, "speed_kph").collect())
    b = sorted(tuple(r) for r in G.gps_avg_by(gps, "speed_kph").collect())
    assert a == b


def test_streamed_values_equal_batch_values(spark, sf):
    frames = [P.parsed_topic(spark, sf, k, mode="stream") for k in P.KINDS]
    path = session.fresh_path(spark, "tables", "values_eq")
    q = BS.start_bronze_stream(frames, path, name="values_eq", checkpoint=C.checkpoint_for(spark, "veq"),
                               trigger="availableNow")
    C.run_to_end(q)
    streamed = BS.read_bronze(spark, path).select("key", "topic", "value", "partition", "offset")
    batch = P.build_bronze(spark, sf).select("key", "topic", "value", "partition", "offset")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_kafka_client_timeouts_pass_through():
    spec = T.TopicSpec(topics=["gps"], starting_offsets="earliest", client=T.REBALANCE_TIMEOUTS)
    opts = T.kafka_options(spec)
    assert opts["kafka.session.timeout.ms"] == "30000"
    assert opts["kafka.request.timeout.ms"] == "40000"
    assert opts["kafka.heartbeat.interval.ms"] == "3000"


def test_streaming_aggregate_update_mode(spark, sf):
    from topiclake.operators import gold as G

    from topiclake.sources.fixtures import topic_messages

    folder = session.fresh_path(spark, "topics", "gps_5_files")
    T.write_topic_folder(topic_messages(spark, sf, "gps").repartition(5), folder)
    src = T.read_folder(spark, folder, envelope("gps"), "kafka-gps", mode="stream",
                        max_files_per_trigger=1).select("data.*")
    out = session.fresh_path(spark, "streams", "upd")

    def keep_updates(batch, batch_id):
        batch.withColumn("_batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    q = C.start(G.gps_avg_by(src, "speed_kph"), "gps_update", C.checkpoint_for(spark, "upd"),
                sink="foreachBatch", foreach_batch=keep_updates, output_mode="update", trigger="availableNow")
    C.run_to_end(q)
    ups = spark.read.parquet(out)
    assert ups.select("_batch_id").distinct().count() > 1  # several micro-batches, updated groups only
    latest = ups.groupBy("speed_kph").agg(F.max_by(F.struct("points", "avg_lat", "avg_lon"), "_batch_id").alias("s"))
    got = sorted((r.speed_kph, r.s.points, r.s.avg_lat, r.s.avg_lon) for r in latest.collect())
    want = sorted(tuple(r) for r in G.gps_avg_by(P.silver(spark, sf, "gps"), "speed_kph").collect())
    assert got == want


def _offset_table(spark, batches):
    path = session.fresh_path(spark, "tables", "ranges")
    for b in range(batches):
        BS.BronzeBatchWriter(path, run="rx" if b % 2 else "ry")(_orders(spark, 30 * b, 30 * b + 30).unionByName(_orders(spark, 30 * b, 30 * b + 3, "a/b c=d")), b)
    return path


@pytest.mark.parametrize("topic", ["kafka-orders", "a/b c=d"])
def test_offset_ranges_open_what_they_need(spark, topic):
    path = _offset_table(spark, 8)
    per = 10 if topic == "kafka-orders" else 1  # rows of a partition per batch

    def check():
        whole = BS.read_bronze(spark, path).where(F.col("topic") == topic)
        for lo, hi in ((0, None), (2 * per, 5 * per), (7 * per, 7 * per + 1), (3 * per, 3 * per), (99 * per, None), (0, 99 * per)):
            got = BS.read_offsets(spark, path, topic, {0: lo, 2: lo}, {0: hi} if hi is not None else None)
            want = whole.where(F.col("partition").isin(0, 2) & (F.col("offset") >= lo) & ((F.col("partition") == 2) | (F.lit(hi).isNull()) | (F.col("offset") < F.lit(hi))))
            assert sorted(map(tuple, got.select("partition", "offset", "key").collect())) == sorted(map(tuple, want.select("partition", "offset", "key").collect())), (lo, hi)

    check()
    few = lambda p: len(BS.read_offsets(spark, p, topic, {0: 2 * per}, {0: 3 * per}).inputFiles())
    assert few(path) == few(_offset_table(spark, 3)) > 0
    BS.compact(spark, path)
    check()


def test_offset_range_of_an_empty_log(spark):
    path = _offset_table(spark, 1)
    assert BS.read_offsets(spark, path, "nobody", {0: 0}).count() == 0
    assert BS.read_offsets(spark, session.fresh_path(spark, "tables", "none"), "x", {0: 0}).count() == 0
