"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables under ``sf_dir`` or data Spark derives
from them (topic folders, bronze tables), over all rows.  Streaming queries
run to the end with ``availableNow`` on fresh checkpoint and output folders
under the shared root, and return the table they wrote, read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake import session
from topiclake.functions.envelope import message_text, parse, rescue
from topiclake.functions.keys import key_partition, key_time
from topiclake.functions.payload import parse_event_time
from topiclake.operators import asof as AO
from topiclake.operators import bronze as B
from topiclake.operators import extensions as E
from topiclake.operators import gold as G
from topiclake.operators import growth as GR
from topiclake.operators import silver as S
from topiclake.plans import topics as P
from topiclake.schemas import (
    BRONZE_DATABASE,
    BRONZE_MULTIPLEX_TABLE,
    FOLDER_TOPICS,
    KAFKA_TOPICS,
    PER_TOPIC_TABLES,
    envelope,
    order_data,
)
from topiclake.sources import fixtures as FX
from topiclake.sources import topics as T
from topiclake.streaming import bronze_stream as BS
from topiclake.streaming import control as C
from topiclake.streaming import event_time as ET
from topiclake.streaming import sequence as SQ

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


ORDER_COLS = ["_sequence_id", "payment_id", "order_key", "amount", "currency", "method", "status", "card_brand",
              "card_last4", "net_amount", "country", "ip_address", "timestamp", "dt_current_timestamp"]
EVENT_COLS = ["_sequence_id", "event_id", "payment_id", "event_name", "event_timestamp", "dt_current_timestamp"]
GPS_COLS = ["_sequence_id", "gps_id", "order_id", "lat", "lon", "speed_kph", "accuracy_m", "timestamp",
            "dt_current_timestamp"]
SUMMARY_TOPIC = FOLDER_TOPICS["orders"]


def _flat_events(df: DataFrame) -> DataFrame:
    """``data`` of an event → flat event columns (nested event struct flattened)."""
    return df.select(
        F.col("data._sequence_id").alias("_sequence_id"),
        F.col("data.event_id").alias("event_id"),
        F.col("data.payment_id").alias("payment_id"),
        F.col("data.event.event_name").alias("event_name"),
        F.col("data.event.timestamp").alias("event_timestamp"),
        F.col("data.dt_current_timestamp").alias("dt_current_timestamp"),
    )


def _seconds_text(ts) -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _stream_to_path(df: DataFrame, name: str, fmt: str = "parquet", partition_by=()) -> DataFrame:
    """Run a stream to the end into a fresh folder; return what it wrote."""
    spark = df.sparkSession
    out = session.fresh_path(spark, "streams", name)
    q = C.start(df, name=f"{name}_{out[-12:]}", checkpoint=C.checkpoint_for(spark, name), sink=fmt, path=out,
                trigger="availableNow", partition_by=partition_by)
    C.run_to_end(q)
    return spark.read.format(fmt).load(out)


def _stream_complete(df: DataFrame, name: str) -> DataFrame:
    """Streaming aggregate in complete mode: every micro-batch replaces the result folder."""
    spark = df.sparkSession
    out = session.fresh_path(spark, "streams", name)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = C.start(df, name=f"{name}_{out[-12:]}", checkpoint=C.checkpoint_for(spark, name), sink="foreachBatch",
                foreach_batch=replace, output_mode="complete", trigger="availableNow")
    C.run_to_end(q)
    return spark.read.parquet(out)


def _bronze_offsets_summary(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.countDistinct("offset").alias("distinct_offsets"),
        F.countDistinct("key").alias("distinct_keys"),
    )


# ================================================================ sources


@query("project_orders")
def project_orders(spark, sf):
    P.prepared(spark)
    return FX.records(spark, sf, "orders").select("data.*")


@query("project_events")
def project_events(spark, sf):
    P.prepared(spark)
    return _flat_events(FX.records(spark, sf, "events"))


@query("project_gps")
def project_gps(spark, sf):
    P.prepared(spark)
    return FX.records(spark, sf, "gps").select("data.*")


@query("batch_read_orders")
def batch_read_orders(spark, sf):
    """Bounded read of the orders topic, earliest to latest, with the fixed schema."""
    return P.parsed_topic(spark, sf, "orders", mode="batch").select("data.*")


@query("stream_read_orders")
def stream_read_orders(spark, sf):
    """Unbounded read of the orders topic folder from the start, parsed and flattened."""
    df = P.parsed_topic(spark, sf, "orders", mode="stream").select("data.*")
    return _stream_to_path(df, "stream_read_orders")


@query("batch_read_offset_range")
def batch_read_offset_range(spark, sf):
    """Offsets of the three topic tables between bounds: from 100 in partition 0, up to 400 in partition 1, all of the others."""
    parts = [B.read_offset_range(P.per_topic_table(spark, sf, k), FOLDER_TOPICS[k], {0: 100}, {1: 400}) for k in P.KINDS]
    return T.union_topics(parts).select("topic", "key", "partition", "offset")


@query("multi_topic_read")
def multi_topic_read(spark, sf):
    """Three topics in one subscription (one folder source per topic, unioned by name)."""
    frames = [P.parsed_topic(spark, sf, k) for k in P.KINDS]
    merged = T.union_topics(frames)
    return merged.select(F.col("_topic_name").alias("topic"), F.col("data._sequence_id").alias("key"))


@query("file_stream_read_events")
def file_stream_read_events(spark, sf):
    """Folder stream of events with explicit schema, no inference, topic tag."""
    df = P.parsed_topic(spark, sf, "events", mode="stream")
    flat = _flat_events(df).withColumn("_topic_name", F.lit(FOLDER_TOPICS["events"]))
    return _stream_to_path(flat, "file_stream_read_events")


@query("rescue_unknown_fields")
def rescue_unknown_fields(spark, sf):
    """Orders messages carrying one member the schema lacks (the order priority): it is rescued, not lost."""
    P.prepared(spark)
    orders = FX.table(spark, sf, "orders")
    data = F.struct(*FX.order_fields(), F.col("o_orderpriority").alias("priority"))
    built = orders.select(message_text(data).alias("value"))
    parsed = built.select(
        parse("value", envelope("orders")).getField("data").alias("data"),
        rescue("value", order_data()).alias("_rescued"),
    )
    return parsed.select(
        F.col("data._sequence_id").alias("_sequence_id"),
        F.explode("_rescued").alias("rescued_key", "rescued_value"),
    )


@query("read_back_gps")
def read_back_gps(spark, sf):
    """GPS silver written to a path, read back by path."""
    out = session.fresh_path(spark, "tables", "gps_silver")
    P.silver(spark, sf, "gps").select(*GPS_COLS).write.option("compression", "zstd").parquet(out)
    return B.read_table(spark, out)


@query("sql_select_bronze")
def sql_select_bronze(spark, sf):
    """Read the bronze multiplex by qualified name in SQL."""
    name = B.register(spark, BRONZE_DATABASE, BRONZE_MULTIPLEX_TABLE, P.bronze_path(spark, sf))
    return spark.sql(f"SELECT key, topic, partition, offset FROM {name}")


@query("describe_bronze_schema")
def describe_bronze_schema(spark, sf):
    """The schema of the stored bronze as rows, with how many values each column holds."""
    return G.column_rows(P.bronze(spark, sf).select(*B.MULTIPLEX_COLUMNS))


@query("topic_file_inventory")
def topic_file_inventory(spark, sf):
    """Files and messages of each topic written with 1000 messages a file (file listing done by the scan, not the driver)."""
    P.prepared(spark)
    frames = []
    for k in P.KINDS:
        path = session.fresh_path(spark, "topics", f"inventory_{k}")
        records = FX.records(spark, sf, k)
        T.write_topic_files(records.select(message_text(F.col("data")).alias("value"), F.col("data._sequence_id").alias("n")), path, "n", 1000)
        frames.append(T.read_folder_text(spark, path, topic=FOLDER_TOPICS[k], with_file=True))
    per_file = T.union_topics(frames).groupBy(F.col("_topic_name").alias("topic"), "_file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("topic").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_messages"), F.max("n").alias("largest_file"))


# ================================================================ sinks


@query("stream_named_orders")
def stream_named_orders(spark, sf):
    """Named append query with its own checkpoint: parsed orders as ``key, data.*`` into a file sink."""
    df = P.parsed_topic(spark, sf, "orders", mode="stream")
    out = df.select(F.col("data.order_key").alias("key"), "data.*")
    return _stream_to_path(out, "query_ordem")


@query("bronze_multiplex_stream")
def bronze_multiplex_stream(spark, sf):
    """Three topic streams → one query → bronze multiplex with gap-free offsets."""
    P.prepared(spark)
    path = session.fresh_path(spark, "tables", "kafka_multiplex_stream")
    cp = C.checkpoint_for(spark, "bronze_multiplex")
    frames = [P.parsed_topic(spark, sf, k, mode="stream") for k in P.KINDS]
    q = BS.start_bronze_stream(frames, path, name=f"bronze_multiplex_{path[-12:]}", checkpoint=cp,
                               trigger="availableNow")
    C.run_to_end(q)
    return BS.read_bronze(spark, path).select("key", "topic", "partition", "offset")


@query("bronze_schema_growth")
def bronze_schema_growth(spark, sf):
    """A stream into the bronze table, then one whose rows have one more column: the merged read shows it (NULL for old rows)."""
    P.prepared(spark)
    path = session.fresh_path(spark, "tables", "bronze_growth")
    for grown in (False, True):
        frames = []
        for k in P.KINDS:
            rows = B.bronze_rows(P.parsed_topic(spark, sf, k, mode="stream"))
            name = F.get_json_object("value", "$.event.event_name") if k == "events" else F.lit(None).cast("string")
            frames.append(rows.withColumn("event_name", name) if grown else rows)
        cp = C.checkpoint_for(spark, f"growth_{grown}")
        q = C.start(T.union_topics(frames), name=f"growth_{grown}_{path[-12:]}", checkpoint=cp, sink="foreachBatch",
                    foreach_batch=BS.BronzeBatchWriter(path, run=BS.run_of(cp)), trigger="availableNow")
        C.run_to_end(q)
    return BS.read_bronze(spark, path, merge_schema=True).select("key", "topic", "event_name")


@query("bronze_per_topic_stream")
def bronze_per_topic_stream(spark, sf):
    """The three per-topic bronze tables written by one stream (one folder per topic)."""
    P.prepared(spark)
    path = session.fresh_path(spark, "tables", "kafka_bronze_stream")
    texts = {k: T.read_topic_text(spark, k, P.topic_path(spark, sf, k), mode="stream") for k in P.KINDS}
    q = BS.start_per_topic_stream(texts, path, name=f"bronze_per_topic_{path[-12:]}",
                                  checkpoint=C.checkpoint_for(spark, "bronze_per_topic"), trigger="availableNow")
    C.run_to_end(q)
    return BS.read_bronze(spark, path, "per_topic").select("key", "partition", "offset", "topic", "timestampType")


@query("stream_gps_to_path")
def stream_gps_to_path(spark, sf):
    df = P.parsed_topic(spark, sf, "gps", mode="stream").select("data.*")
    return _stream_to_path(df, "stream_gps_to_path")


def _per_topic_key(kind: str) -> Query:
    def run(spark, sf):
        return P.per_topic_table(spark, sf, kind).select("key", "partition", "offset", "topic", "timestampType")

    return run


for _k in P.KINDS:
    QUERIES[f"bronze_per_topic_{_k}"] = _per_topic_key(_k)


@query("to_topic_records")
def to_topic_records(spark, sf):
    """Keyed JSON records of the three topics written to topic folders, read back."""
    P.prepared(spark)
    path = session.fresh_path(spark, "topics", "records")
    msgs = T.union_topics([FX.topic_messages(spark, sf, k) for k in P.KINDS])
    T.write_topic_records(msgs, path)
    back = spark.read.schema("key STRING, value STRING, topic STRING").json(path)
    return back.select("topic", "key", F.get_json_object("value", "$.data._sequence_id").cast("long").alias("_sequence_id"))


@query("topic_files_roundtrip")
def topic_files_roundtrip(spark, sf):
    """Orders messages written as JSON documents into a topic folder and read back with the schema."""
    P.prepared(spark)
    path = session.fresh_path(spark, "topics", "orders_docs")
    FX.records(spark, sf, "orders").write.json(path)
    return spark.read.schema(envelope("orders")).json(path).select("data.*")


@query("list_bronze_tables")
def list_bronze_tables(spark, sf):
    """The per-topic tables that the catalog lists, with the rows that each holds."""
    for k in P.KINDS:
        B.register(spark, BRONZE_DATABASE, PER_TOPIC_TABLES[k], P.per_topic_path(spark, sf, k))
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {BRONZE_DATABASE} LIKE 'kafka_bronze*'").collect()]
    return T.union_topics([spark.table(f"{BRONZE_DATABASE}.{n}").agg(F.lit(n).alias("tableName"), F.count(F.lit(1)).alias("n_rows")) for n in names])


# ================================================================ projections


@query("select_rename")
def select_rename(spark, sf):
    frames = T.union_topics([P.parsed_topic(spark, sf, k) for k in P.KINDS])
    out = frames.select(
        F.col("data._sequence_id").alias("key"),
        F.to_json("data").alias("value"),
        F.col("_topic_name").alias("topic"),
    )
    link = F.coalesce(F.get_json_object("value", "$.payment_id"), F.get_json_object("value", "$.order_id"))
    return out.select("key", "topic", link.alias("link_id"))


@query("kafka_record_as_text")
def kafka_record_as_text(spark, sf):
    """Kafka records with binary key/value cast to text, the message parsed."""
    rec = P.per_topic_table(spark, sf, "orders")
    as_kafka = rec.select(F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
                          "topic", "partition", "offset", "timestamp", "timestampType")
    text = as_kafka.selectExpr("CAST(key AS STRING) AS order_key", "CAST(value AS STRING) AS message", "partition",
                               "offset")
    msg = parse("message", envelope("orders")).getField("data")
    return text.select("order_key", "partition", "offset", msg["amount"].alias("amount"),
                       msg["status"].alias("status"))


def _flatten_key(kind: str) -> Query:
    def run(spark, sf):
        rec = B.kafka_rows(P.message_lines(spark, sf, kind), FX.MESSAGE_KEY[kind])  # flattening needs no offsets, so no shuffle
        parsed = rec.select("key", parse("value", envelope(kind)).alias("json_data"),
                            F.col("timestamp").alias("kafka_timestamp"))
        flat = parsed.select("key", "json_data.data.*", "kafka_timestamp")
        if kind == "events":
            flat = flat.select("key", "_sequence_id", "event_id", "payment_id", F.col("event.event_name").alias("event_name"),
                               F.col("event.timestamp").alias("event_timestamp"), "dt_current_timestamp",
                               "kafka_timestamp")
        return flat.withColumn("kafka_timestamp", _seconds_text("kafka_timestamp"))

    return run


for _k in P.KINDS:
    QUERIES[f"flatten_{_k}"] = _flatten_key(_k)


@query("nested_event_name")
def nested_event_name(spark, sf):
    df = P.parsed_topic(spark, sf, "events")
    return df.select(F.col("data._sequence_id").alias("key"), F.col("data.event.event_name").alias("event_name"))


@query("tag_topic")
def tag_topic(spark, sf):
    frames = T.union_topics([P.parsed_topic(spark, sf, k) for k in P.KINDS])
    return frames.select(F.col("data._sequence_id").alias("_sequence_id"), "_topic_name")


@query("bronze_batch")
def bronze_batch(spark, sf):
    """Bronze multiplex built by batch (offsets by the range plan), cast to the bronze schema."""
    b = P.build_bronze(spark, sf)
    return b.select("key", "topic", "partition", "offset", _seconds_text("timestamp").alias("timestamp"))


@query("gps_points")
def gps_points(spark, sf):
    return S.gps_points(P.silver(spark, sf, "gps"))


@query("key_as_timestamp")
def key_as_timestamp(spark, sf):
    P.prepared(spark)
    orders = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    return orders.select("key", _seconds_text(key_time("key")).alias("key_time"))


# ================================================================ filters


@query("silver_orders")
def silver_orders(spark, sf):
    """Orders from a bronze in which every 97th message lost its payload: those rows are dropped, the others parsed with a DDL schema."""
    holed = P.bronze(spark, sf).withColumn("value", F.when(F.col("key") % 97 != 0, F.col("value")))
    return S.orders(holed).select("key", "partition", "offset", *ORDER_COLS)


@query("silver_from_per_topic")
def silver_from_per_topic(spark, sf):
    """Silver events out of the per-topic table, whose value is the whole message."""
    ev = S.events(P.per_topic_table(spark, sf, "events"))
    return ev.select("key", "partition", "offset", "_sequence_id", "event_id", "payment_id", "event_name", "event_timestamp")


@query("gold_from_per_topic")
def gold_from_per_topic(spark, sf):
    """The status summary in SQL over the per-topic table (value = the whole message)."""
    view = f"tl_orders_{T._fingerprint(spark, sf)}"
    P.per_topic_table(spark, sf, "orders").createOrReplaceTempView(view)
    return spark.sql(G.status_summary_sql(view, form="message"))


@query("kafka_shape_multiplex")
def kafka_shape_multiplex(spark, sf):
    """Kafka records without sequence ids under the Kafka topic names: bronze multiplex with the broker's metadata, then silver of all topics."""
    parts = []
    for k, link in (("orders", "payment_id"), ("events", "event_id"), ("gps", "gps_id")):
        t = P.per_topic_table(spark, sf, k)
        bare = F.regexp_replace("value", r'"_sequence_id":\d+,?', "")
        b = B.multiplex_from_kafka(t.select("key", bare.alias("value"), F.lit(KAFKA_TOPICS[k]).alias("topic"), "partition", "offset", "timestamp", "timestampType"))
        ids = {"orders": S.orders, "events": S.events, "gps": S.gps}[k](b).select("topic", "partition", "offset", F.col(link).alias("link"))
        parts.append(b.select("topic", "partition", "offset", "key", "message_key").join(ids, ["topic", "partition", "offset"]))
    return T.union_topics(parts)


@query("bronze_with_rescue")
def bronze_with_rescue(spark, sf):
    """Bronze out of topics with unknown members and broken lines: both are kept beside the record."""
    P.prepared(spark)
    parts = []
    for k in P.KINDS:
        m = FX.topic_messages(spark, sf, k)
        number = F.get_json_object("value", "$.data._sequence_id").cast("long")
        odd = F.when(number % 89 == 0, F.concat(F.lit("{bad "), number.cast("string"))).when(
            number % 7 == 0, F.regexp_replace("value", r'^\{"data":\{', '{"data":{"extra":"x",')).otherwise(F.col("value"))
        path = session.fresh_path(spark, "topics", f"rescue_{k}")
        T.write_topic_folder(m.select(odd.alias("value")), path)
        parts.append(T.read_topic(spark, k, path=path, rescue_unknown=True))
    b = B.multiplex(parts)
    return b.select("topic", "key", F.element_at("_rescued", "extra").alias("extra"), F.col("_corrupt_record").alias("corrupt"),
                    (F.col("value") == F.col("_corrupt_record")).alias("kept"))


@query("bronze_demux_topic")
def bronze_demux_topic(spark, sf):
    return S.demux(P.bronze(spark, sf), "orders").select("key", "partition", "offset")


# ================================================================ aggregations


@query("bronze_count_by_topic")
def bronze_count_by_topic(spark, sf):
    return G.count_by_topic(P.bronze(spark, sf))


@query("bronze_partition_distribution")
def bronze_partition_distribution(spark, sf):
    return G.partition_distribution(P.bronze(spark, sf))


@query("bronze_max_offset")
def bronze_max_offset(spark, sf):
    return G.max_offset(P.bronze(spark, sf))


@query("bronze_total_rows")
def bronze_total_rows(spark, sf):
    return G.total_rows(P.bronze(spark, sf))


@query("bronze_rows_per_table")
def bronze_rows_per_table(spark, sf):
    parts = []
    for k in P.KINDS:
        t = P.per_topic_table(spark, sf, k)
        parts.append(G.total_rows(t).select(F.lit(PER_TOPIC_TABLES[k]).alias("table_name"), "total_rows"))
    return T.union_topics(parts)


@query("topic_message_count")
def topic_message_count(spark, sf):
    parts = [G.total_rows(P.parsed_topic(spark, sf, k)).select(F.lit(FOLDER_TOPICS[k]).alias("topic"),
                                                                F.col("total_rows").alias("message_count"))
             for k in P.KINDS]
    return T.union_topics(parts)


def _since_total(spark: SparkSession, out: str, before: int | None) -> DataFrame:
    """Partials from the last total on: those of batches under ``before`` (None: all)."""
    parts = spark.read.parquet(out)
    if before is not None:
        parts = parts.where(F.col("_batch_id") < before)
    newest = parts.agg(F.max("_batch_id")).first()[0] or 0
    return parts.where(F.col("_batch_id") >= newest // 50 * 50).drop("_batch_id")


@query("stream_gps_avg_by_order")
def stream_gps_avg_by_order(spark, sf):
    """Per-order points and average position from a stream, for a key space that grows with the data.

    Complete mode would rewrite every order each micro-batch and keep one state
    row per order.  Count and average decompose, so each micro-batch appends
    its own partial aggregates (overwriting its ``_batch_id`` on replay) and the
    read merges them: append-only, no state store, exactly once.  Every 50th batch
    carries the total of all before it, so a read merges at most 50 batches and one total.
    """
    gps = P.parsed_topic(spark, sf, "gps", mode="stream").select("data.*")
    out = session.fresh_path(spark, "streams", "gps_partials")

    def append_partials(batch: DataFrame, batch_id: int) -> None:
        parts = G.gps_partials(batch, "order_id")
        if batch_id and batch_id % 50 == 0:  # the batches since the last total are folded into this one
            parts = G.fold_gps_partials(parts.unionByName(_since_total(spark, out, batch_id)), "order_id")
        parts = parts.withColumn("_batch_id", F.lit(batch_id).cast("long"))
        (parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch_id").parquet(out))

    q = C.start(gps, name=f"gps_by_order_{out[-12:]}", checkpoint=C.checkpoint_for(spark, "gps_by_order"),
                sink="foreachBatch", foreach_batch=append_partials, trigger="availableNow")
    C.run_to_end(q)
    return G.merge_gps_partials(_since_total(spark, out, None), "order_id")


@query("stream_gps_avg_by_speed")
def stream_gps_avg_by_speed(spark, sf):
    gps = P.parsed_topic(spark, sf, "gps", mode="stream").select("data.*")
    return _stream_complete(G.gps_avg_by(gps, "speed_kph"), "gps_avg_by_speed")


@query("gps_count_by_speed")
def gps_count_by_speed(spark, sf):
    return G.gps_count_by(P.silver(spark, sf, "gps"), "speed_kph")


@query("orders_by_method")
def orders_by_method(spark, sf):
    return G.orders_by_method(P.silver(spark, sf, "orders"))


@query("avg_amount_by_status")
def avg_amount_by_status(spark, sf):
    return G.avg_amount_by_status(P.silver(spark, sf, "orders"))


@query("gold_status_summary")
def gold_status_summary(spark, sf):
    view = f"tl_bronze_{T._fingerprint(spark, sf)}"  # one view per data set
    P.bronze(spark, sf).createOrReplaceTempView(view)
    return spark.sql(G.status_summary_sql(view))


@query("orders_count_by_partition")
def orders_count_by_partition(spark, sf):
    return G.count_by_partition(P.per_topic_table(spark, sf, "orders"))


@query("orders_max_offset")
def orders_max_offset(spark, sf):
    return G.max_offset_by_partition(P.per_topic_table(spark, sf, "orders"))


# ================================================================ windows


@query("assign_offsets")
def assign_offsets_query(spark, sf):
    """Offsets of the multiplex computed by the range plan."""
    return P.build_bronze(spark, sf).select("topic", "partition", "key", "offset")


@query("event_sequence")
def event_sequence(spark, sf):
    ev = P.silver(spark, sf, "events")
    return S.event_sequence(ev).select("payment_id", "event_id", "event_name", "event_timestamp", "seq")


# ================================================================ sorts / limits


@query("bronze_last_10")
def bronze_last_10(spark, sf):
    return G.preview(P.bronze(spark, sf)).select("key", "topic", "partition", "offset")


@query("orders_latest_10")
def orders_latest_10(spark, sf):
    return G.latest(P.per_topic_table(spark, sf, "orders")).select("key", "partition", "offset")


@query("gps_sorted_desc")
def gps_sorted_desc(spark, sf):
    """All points, the latest first; ``place`` is each row's position in the sorted output."""
    g = P.silver(spark, sf, "gps").select("gps_id", "order_id", "timestamp")
    from topiclake.operators.offsets import assign_offsets

    rows = g.withColumns({"_all": F.lit(0), "_back": -F.unix_micros(parse_event_time("timestamp"))})
    last = F.translate("gps_id", "0123456789", "9876543210")  # ids of one length in descending order
    rows = assign_offsets(rows, ("_all",), ("_back", -F.length("gps_id"), last), "place")
    return rows.select("gps_id", "order_id", "timestamp", "place").orderBy("place")  # numbering deals the rows out, so they are sorted after it


@query("bronze_sample_5")
def bronze_sample_5(spark, sf):
    """Five rows of bronze, the same ones every time."""
    return G.sample(P.bronze(spark, sf).select("topic", "key", "partition", "offset"), 5, repeatable=True)


@query("last_100_per_topic")
def last_100_per_topic(spark, sf):
    return G.last_per_topic(P.bronze(spark, sf), 100).select("topic", "key", "partition", "offset")


# ================================================================ set operations


@query("multiplex_topics")
def multiplex_topics(spark, sf):
    rows = [B.bronze_rows(P.parsed_topic(spark, sf, k)) for k in P.KINDS]
    return T.union_topics(rows).select("topic", "key", "partition")


@query("distinct_topics")
def distinct_topics(spark, sf):
    return G.distinct_topics(P.bronze(spark, sf))


# ================================================================ scalar functions


@query("json_parse_orders")
def json_parse_orders(spark, sf):
    text = T.read_folder_text(spark, P.topic_path(spark, sf, "orders"))
    P.prepared(spark)
    return text.select(parse("value", envelope("orders")).alias("m")).select("m.data.*")


@query("parse_event_props")
def parse_event_props(spark, sf):
    ev = FX.table(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", parse("props", "k INT")["k"].alias("k"))


@query("key_partition")
def key_partition_query(spark, sf):
    P.prepared(spark)
    o = FX.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.lit("kafka-orders").alias("topic"))
    o = o.unionByName(o.withColumn("topic", F.lit("kafka-gps")))
    e = FX.table(spark, sf, "events").select(F.col("event_id").alias("key"), F.lit("kafka-events").alias("topic"))
    return o.unionByName(e).select("topic", "key", key_partition("key").alias("partition"))


@query("net_amount_decimal")
def net_amount_decimal(spark, sf):
    return FX.records(spark, sf, "orders").select("data._sequence_id", "data.amount", "data.net_amount")


@query("value_preview")
def value_preview(spark, sf):
    ev = FX.table(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", F.substring("props", 1, 100).alias("value_preview"))


# ================================================================ stream control


def _split_topics(spark, sf, name: str, files: int = 6) -> dict[str, str]:
    """The three topics as folders of ``files`` files each."""
    paths = {}
    for k in P.KINDS:
        paths[k] = session.fresh_path(spark, "topics", f"{name}_{k}")
        T.write_topic_folder(T.in_files(FX.topic_messages(spark, sf, k), files), paths[k])
    return paths


def _bronze_run(spark, paths: dict[str, str], path: str, name: str, checkpoint: str, max_files: int | None = None) -> None:
    """One run of the bronze stream over topic folders, to the end of what is there."""
    frames = [T.read_topic(spark, k, path=p, mode="stream", max_files_per_trigger=max_files) for k, p in paths.items()]
    C.run_to_end(BS.start_bronze_stream(frames, path, name=f"{name}_{path[-12:]}", checkpoint=checkpoint, trigger="availableNow"))


def _folders(spark, sf) -> dict[str, str]:
    P.prepared(spark)
    return {k: P.topic_path(spark, sf, k) for k in P.KINDS}


@query("stream_resume_no_duplicates")
def stream_resume_no_duplicates(spark, sf):
    """Half of each topic's files in several micro-batches, then the rest on the same checkpoint: every message once, offsets gap-free."""
    first, later = _folders(spark, sf), {}
    whole = {k: session.fresh_path(spark, "topics", f"resume_all_{k}") for k in P.KINDS}
    for k in P.KINDS:
        lines = T.read_folder_text(spark, first[k])
        odd = F.xxhash64("value") % 2 == 0
        T.write_topic_folder(T.in_files(lines, 3, odd), whole[k])
        later[k] = T.in_files(lines, 3, ~odd)
    path, cp = session.fresh_path(spark, "tables", "resume"), C.checkpoint_for(spark, "resume")
    _bronze_run(spark, whole, path, "resume_1", cp, max_files=1)
    for k in P.KINDS:
        T.write_topic_folder(later[k], whole[k], mode="append")
    _bronze_run(spark, whole, path, "resume_2", cp, max_files=1)
    b = BS.read_bronze(spark, path)
    several = b.agg((F.countDistinct("_batch_id") >= 4).alias("several_batches"))
    return _bronze_offsets_summary(b).crossJoin(several)  # one row beside the summary


@query("stream_replay_idempotent")
def stream_replay_idempotent(spark, sf):
    """A micro-batch written again under the same batch id, as after a lost commit, adds and changes nothing."""
    path, cp = session.fresh_path(spark, "tables", "replay_same"), C.checkpoint_for(spark, "replay_same")
    _bronze_run(spark, _folders(spark, sf), path, "replay_same", cp)
    again = T.union_topics([B.bronze_rows(P.parsed_topic(spark, sf, k)) for k in P.KINDS])
    BS.BronzeBatchWriter(path, run=BS.run_of(cp))(again, 0)
    return _bronze_offsets_summary(BS.read_bronze(spark, path))


@query("stream_replay_duplicates")
def stream_replay_duplicates(spark, sf):
    """A fresh checkpoint reprocesses every file: rows come again (the table is not cleared), offsets go on."""
    path = session.fresh_path(spark, "tables", "replay_fresh")
    for tag in "ab":
        _bronze_run(spark, _folders(spark, sf), path, f"replay_{tag}", C.checkpoint_for(spark, f"replay_{tag}"))
    b = BS.read_bronze(spark, path)
    return b.groupBy("topic").agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("key").alias("distinct_keys"),
                                  F.countDistinct("partition", "offset").alias("distinct_offsets"))


@query("stream_interleaved_runs")
def stream_interleaved_runs(spark, sf):
    """Two runs take turns on one table, then batches of both are replayed: offsets stay unique and gap-free."""
    P.prepared(spark)
    path = session.fresh_path(spark, "tables", "interleaved")
    rows = T.union_topics([B.bronze_rows(P.parsed_topic(spark, sf, k)) for k in P.KINDS])
    third = F.pmod(F.col("key"), F.lit(3))
    for run, batch, part in (("a", 0, 0), ("b", 0, 1), ("a", 1, 2), ("a", 0, 0), ("b", 0, 1)):
        BS.BronzeBatchWriter(path, run=BS.run_of(run))(rows.where(third == part), batch)
    return _bronze_offsets_summary(BS.read_bronze(spark, path))


@query("stream_read_from_offset")
def stream_read_from_offset(spark, sf):
    """A consumer that starts at the latest offsets sees only what is appended afterwards.

    Run 1 writes the topics to a streamed bronze table; the consumer takes
    the latest offset of every partition; run 2 (fresh checkpoint) appends the
    topics again; the consumer stream delivers run 2's rows only.
    """
    path = session.fresh_path(spark, "tables", "from_latest")
    _bronze_run(spark, _folders(spark, sf), path, "from_latest_a", C.checkpoint_for(spark, "from_latest_a"))
    start = BS.latest_offsets(BS.read_bronze(spark, path))
    _bronze_run(spark, _folders(spark, sf), path, "from_latest_b", C.checkpoint_for(spark, "from_latest_b"))
    consumer = BS.read_bronze_stream(spark, path, starting=start).select("topic", "key", "partition", "offset")
    return _stream_to_path(consumer, "consumer_from_latest")


@query("stream_bronze_sql_table")
def stream_bronze_sql_table(spark, sf):
    """The streamed bronze by qualified name in SQL: the table learns of every micro-batch and of the compaction afterwards."""
    P.prepared(spark)
    path = session.fresh_path(spark, "tables", "named_stream")
    name = f"{BRONZE_DATABASE}.stream_{path[-12:]}"
    paths = _split_topics(spark, sf, "named", files=3)
    frames = [T.read_topic(spark, k, path=p, mode="stream", max_files_per_trigger=1) for k, p in paths.items()]
    C.run_to_end(BS.start_bronze_stream(frames, path, name=f"named_{path[-12:]}", checkpoint=C.checkpoint_for(spark, "named"),
                                        trigger="availableNow", table=name))
    BS.compact(spark, path)
    named = spark.sql(f"SELECT topic, count(*) AS in_table FROM {name} GROUP BY topic")
    after = BS.read_bronze(spark, path).groupBy("topic").agg(F.count(F.lit(1)).alias("compacted"), F.countDistinct("partition", "offset").alias("offsets"))
    return named.join(after, "topic")


@query("stream_offset_range")
def stream_offset_range(spark, sf):
    """Offsets of a streamed bronze table between bounds, before and after some of its batches are merged: the commit log names the folders to open."""
    P.prepared(spark)
    path, cp = session.fresh_path(spark, "tables", "offset_range"), C.checkpoint_for(spark, "offset_range")
    paths = _split_topics(spark, sf, "offset_range", files=4)
    _bronze_run(spark, paths, path, "offset_range", cp, max_files=1)
    topic = FOLDER_TOPICS["orders"]
    parts = [BS.read_offsets(spark, path, topic, {0: 100, 1: 50}, {0: 400}).withColumn("merged", F.lit(False))]
    rows = parts[0].select("partition", "offset", "merged")
    kept = session.fresh_path(spark, "tables", "offset_range_kept")
    rows.write.parquet(kept)  # read before the folders change
    BS.compact(spark, path)
    after = BS.read_offsets(spark, path, topic, {0: 100, 1: 50}, {0: 400}).select("partition", "offset", F.lit(True).alias("merged"))
    return spark.read.parquet(kept).unionByName(after)


@query("bronze_typed_growth")
def bronze_typed_growth(spark, sf):
    """Orders with members that the schema lacks, of types that differ from row to row: each becomes a column of the least type that holds its values."""
    P.prepared(spark)
    k = F.col("o_orderkey")
    number = F.when(k % 3 == 0, k.cast("string")).otherwise(F.concat(k.cast("string"), F.lit(".25")))
    mixed = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit('"p'), k.cast("string"), F.lit('"')))
    place = F.concat(F.lit('{"shelf":'), (k % 7).cast("string"), F.when(k % 5 == 0, F.lit(',"row":1.5}')).otherwise(F.lit("}")))
    more = F.concat(F.lit(',"units":'), (k % 50).cast("string"), F.lit(',"weight":'), number, F.lit(',"lot":'), mixed, F.lit(',"place":'), place, F.lit(',"tags":['), (k % 4).cast("string"), F.lit("]"))
    orders = FX.order_record(FX.table(spark, sf, "orders")).select(F.col("data"), F.to_json("data").alias("json")).withColumn("o_orderkey", F.col("data._sequence_id"))
    lines = orders.select(F.concat(F.lit('{"data":'), F.expr("substring(json, 1, length(json) - 1)"), more, F.lit("}}")).alias("value"))
    rows = lines.select(parse("value", envelope("orders")).getField("data").getField("_sequence_id").alias("key"), F.lit("orders").alias("topic"), rescue("value", order_data()).alias("_rescued"))
    out = GR.grown(rows)
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    return out.agg(*[F.lit(types[c]).alias(f"{c}_type") for c in ("units", "weight", "lot", "place", "tags")], F.sum("units").alias("units"), F.sum(F.col("weight").cast("decimal(38,2)")).cast("double").alias("weight"),
                   F.countDistinct("lot").alias("lots"), F.sum("place.shelf").cast("long").alias("shelves"), F.sum("place.row").cast("double").alias("rows"), F.sum(F.col("tags")[0]).cast("long").alias("tags"),
                   F.count(F.when(F.size("_rescued") > 0, 1)).alias("left_over"))


@query("three_queries_total")
def three_queries_total(spark, sf):
    """Three independent named queries on one session, waited for together."""
    P.prepared(spark)
    spark.streams.resetTerminated()
    outs, queries = {}, []
    for k in P.KINDS:
        df = P.parsed_topic(spark, sf, k, mode="stream").select(F.col("_topic_name").alias("topic"),
                                                                 F.col("data._sequence_id").alias("key"))
        out = session.fresh_path(spark, "streams", f"query_{k}")
        outs[k] = out
        queries.append(C.start(df, name=f"query_{k}_{out[-12:]}", checkpoint=C.checkpoint_for(spark, f"q_{k}"),
                               sink="parquet", path=out, trigger="availableNow"))
    C.run_all(spark, queries)
    parts = [spark.read.parquet(o) for o in outs.values()]
    return T.union_topics(parts).groupBy("topic").agg(F.count(F.lit(1)).alias("rows"))


def order_view(df: DataFrame) -> DataFrame:
    """The one transformation used by batch and by stream."""
    return df.select("data.*").withColumn("order_time", parse_event_time("timestamp"))


@query("batch_equals_stream")
def batch_equals_stream(spark, sf):
    """Same transform on the bounded and the unbounded read of every topic: streamed rows, and how many the batch read lacks or has beyond them."""
    parts = []
    for k in P.KINDS:
        def view(df, kind=k):
            return df.select(F.lit(FOLDER_TOPICS[kind]).alias("topic"), F.to_json("data").alias("value"))

        streamed = _stream_to_path(view(P.parsed_topic(spark, sf, k, mode="stream")), f"batch_vs_stream_{k}")
        batch = view(P.parsed_topic(spark, sf, k))
        both = streamed.withColumn("n", F.lit(1)).unionByName(batch.withColumn("n", F.lit(-1)))
        parts.append(both.groupBy("topic", F.xxhash64("value").alias("h")).agg(F.sum("n").alias("n"), F.sum(F.greatest("n", F.lit(0))).alias("rows")))
    return T.union_topics(parts).groupBy("topic").agg(F.sum("rows").alias("streamed_rows"), F.sum(F.abs("n")).alias("differences"))


@query("stream_progress_rows")
def stream_progress_rows(spark, sf):
    """Batches and input rows of three queries, from a log that keeps every progress event."""
    P.prepared(spark)
    spark.streams.resetTerminated()
    log = C.ProgressLog(spark)
    qs = []
    for k in P.KINDS:
        df = P.parsed_topic(spark, sf, k, mode="stream").select("data._sequence_id")
        out = session.fresh_path(spark, "streams", f"progress_{k}")
        qs.append(C.start(df, name=f"progress_{k}_{out[-12:]}", checkpoint=C.checkpoint_for(spark, f"p_{k}"),
                          sink="parquet", path=out, trigger="availableNow"))
    C.run_all(spark, qs)
    events = log.frame(qs)
    log.close()
    own = [str(q.runId) for q in qs]
    return events.where(F.col("run_id").isin(own) & (F.col("num_input_rows") > 0)).select("batch_id", "num_input_rows")


# ================================================================ extensions


@query("ext_events_tumbling")
def ext_events_tumbling(spark, sf):
    P.prepared(spark)
    return E.tumbling_counts(E.event_times(FX.table(spark, sf, "events")), "1 hour")


@query("ext_events_sliding")
def ext_events_sliding(spark, sf):
    P.prepared(spark)
    return E.sliding_counts(E.event_times(FX.table(spark, sf, "events")), "2 hours", "1 hour")


@query("ext_events_session")
def ext_events_session(spark, sf):
    P.prepared(spark)
    return E.session_counts(E.event_times(FX.table(spark, sf, "events")), "30 minutes")


@query("ext_watermark_counts")
def ext_watermark_counts(spark, sf):
    """Events as a stream with a 10-minute watermark: hourly counts, emitted once closed."""
    P.prepared(spark)
    src = (spark.readStream.schema(FX.table(spark, sf, "events").schema)
           .option("pathGlobFilter", "events.parquet").parquet(sf))
    counts = E.watermarked_counts(E.event_times(src), "1 hour", "10 minutes")
    return _stream_to_path(counts, "watermark_counts")


@query("ext_events_sliding_day")
def ext_events_sliding_day(spark, sf):
    """Windows of a day that start every 5 minutes: 288 a row, made from 5-minute panes."""
    P.prepared(spark)
    return E.sliding_counts(E.event_times(FX.table(spark, sf, "events")), "24 hours", "5 minutes")


# ---------------------------------------------------------------- event time on streams


def _delivered(messages: DataFrame, name: str, n: int, beat: str):
    """A topic folder that is filled in ``n`` deliveries: (folder, function that makes delivery i).

    ``messages``: ``value`` and ``delivery`` (0 … n - 1).  Delivery n is the beat alone, a message that only says that the
    topic has nothing older to come.
    """
    spark = messages.sparkSession
    kept, folder = session.fresh_path(spark, "topics", f"{name}_kept"), session.fresh_path(spark, "topics", name)
    messages.select("value", "delivery").write.partitionBy("delivery").parquet(kept)

    def deliver(i: int) -> None:
        lines = spark.read.schema("value STRING, delivery INT").parquet(kept).where(F.col("delivery") == i)
        T.write_topic_folder(lines if i < n else spark.range(1).select(F.lit(beat).alias("value")), folder, T.RECORDS_PER_FILE, mode="append")

    return folder, deliver


def _in_turns(start, deliveries: list, n: int) -> list:
    """Each delivery is made and streamed to its end by a query that is then over: the next one restarts from the checkpoint."""
    queries = []
    for i in range(n + 1):
        for deliver in deliveries:
            deliver(i)
        queries.append(C.run_to_end(start()))
    return queries


def _event_messages(spark, sf, delivery) -> DataFrame:
    """Messages of the events topic with the delivery they come in (an expression over the events table)."""
    ev = FX.table(spark, sf, "events")
    rec = FX.event_record(ev.select("event_id", "ts", "user_id", "event_type"))
    ids = ev.select(F.col("event_id").alias("id"), delivery.cast("int").alias("delivery"))
    return rec.join(ids, F.col("data._sequence_id") == F.col("id")).select(message_text(F.col("data")).alias("value"), "delivery")


def _slice(ts, days: int, most: int):
    """The delivery of a time: ``days`` days of January 2024 each."""
    return F.least(F.floor((F.unix_timestamp(F.col(ts).cast("timestamp")) - FIRST_SECOND) / (86400 * days)), F.lit(most))


FIRST_SECOND = 1_704_067_200  # 2024-01-01, the first event
EVENT_BEAT = '{"data":{"event_id":"beat","payment_id":"beat","event":{"timestamp":"' + ET.BEAT + '.000"},"dt_current_timestamp":"' + ET.BEAT + '.000"}}'
ORDER_BEAT = '{"data":{"payment_id":"beat","timestamp":"' + ET.BEAT + '.000"}}'


def _event_stream(spark, folder: str) -> DataFrame:
    rows = _flat_events(T.read_topic(spark, "events", path=folder, mode="stream"))
    return rows.withColumn("event_time", parse_event_time("event_timestamp"))


def stream_payment_events(spark, sf) -> tuple[str, list]:
    """Folder and queries of the streamed join: three deliveries of both topics and a beat, a restart between them."""
    P.prepared(spark)
    paid = F.timestamp_seconds(F.lit(FIRST_SECOND) + (F.col("o_orderkey") % 174) * 4 * 3600)
    orders = FX.table(spark, sf, "orders").withColumn("o_orderdate", paid)
    orders = FX.order_record(orders).select(message_text(F.col("data")).alias("value"), _slice("data.timestamp", 10, 2).cast("int").alias("delivery"))
    o_folder, o_deliver = _delivered(orders, "paid_orders", 3, ORDER_BEAT)
    e_folder, e_deliver = _delivered(_event_messages(spark, sf, _slice("ts", 10, 2)), "paid_events", 3, EVENT_BEAT)
    out, cp = session.fresh_path(spark, "streams", "payment_events"), C.checkpoint_for(spark, "payment_events")
    state = ET.join_state(spark, sum(FX.table(spark, sf, name).count() for name in ("orders", "events")))

    def start():
        o = T.read_topic(spark, "orders", path=o_folder, mode="stream").select("data.payment_id", parse_event_time("data.timestamp").alias("paid_at"))
        e = _event_stream(spark, e_folder).select("payment_id", "event_id", "event_name", "event_time")
        joined = ET.left_join_in_time(o, e, "payment_id", "paid_at", "event_time", within="1 DAY")
        with session.settings(spark, state):
            return C.start(joined, f"payment_events_{out[-12:]}", cp, path=out, trigger="availableNow")

    return out, _in_turns(start, [o_deliver, e_deliver], 3)


@query("ext_stream_payment_events")
def ext_stream_payment_events(spark, sf):
    """Each order with the events of its payment in the day after it, as a stream-stream left outer join restarted in mid-stream."""
    out, _ = stream_payment_events(spark, sf)
    fmt = "yyyy-MM-dd HH:mm:ss.SSS"
    return spark.read.parquet(out).select("payment_id", F.date_format("paid_at", fmt).alias("paid_at"), "event_id", "event_name",
                                          F.date_format("event_time", fmt).alias("event_time"))


@query("ext_windows_and_late")
def ext_windows_and_late(spark, sf):
    """Hourly counts closed by a watermark, and the events that came after their window was closed: a fifth is delivered by a hash."""
    P.prepared(spark)
    mixed = F.col("event_id") * 7919
    dealt = F.when(mixed % 5 == 0, F.floor(mixed / 5) % 3).otherwise(_slice("ts", 10, 2))
    folder, deliver = _delivered(_event_messages(spark, sf, dealt), "late_events", 3, EVENT_BEAT)
    out, cp = session.fresh_path(spark, "streams", "windows_and_late"), C.checkpoint_for(spark, "windows_and_late")
    schemas = []

    def start():
        rows = ET.windows_and_late(_event_stream(spark, folder).select("event_id", "event_name", "event_time"), "event_name", "event_time", 3600, "10 minutes")
        schemas.append(rows.schema)
        return C.start(rows, f"windows_and_late_{out[-12:]}", cp, sink="foreachBatch", foreach_batch=ET.WindowSink(out), trigger="availableNow")

    _in_turns(start, [deliver], 3)
    windows, late = ET.read_windows(spark, out, schemas[0])
    windows = windows.select(F.lit("window").alias("kind"), _seconds_text("window_start").alias("window_start"), F.col("key").alias("event_name"), "n", F.lit(None).cast("string").alias("event_id"))
    late = late.select(F.lit("late").alias("kind"), _seconds_text("window_start").alias("window_start"), "event_name", F.lit(1).cast("long").alias("n"), "event_id")
    return windows.unionByName(late)


@query("ext_stream_sessions")
def ext_stream_sessions(spark, sf):
    """Sessions of each payment over a stream whose every seventh event comes one delivery late."""
    P.prepared(spark)
    late = _slice("ts", 10, 2) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    folder, deliver = _delivered(_event_messages(spark, sf, F.least(late, F.lit(2))), "session_events", 3, EVENT_BEAT)
    out, cp = session.fresh_path(spark, "streams", "sessions"), C.checkpoint_for(spark, "sessions")

    def start():
        rows = ET.stream_sessions(_event_stream(spark, folder), "payment_id", "event_time", "30 minutes", delay="11 days")
        return C.start(rows, f"sessions_{out[-12:]}", cp, path=out, trigger="availableNow")

    _in_turns(start, [deliver], 3)
    return spark.read.parquet(out).select("payment_id", _seconds_text("session_start").alias("window_start"), _seconds_text("session_end").alias("window_end"), "n")


@query("ext_stream_without_resent")
def ext_stream_without_resent(spark, sf):
    """Events of which some are sent again after 12 hours (dropped) and some after 15 days, beyond the day that ids are kept (new messages)."""
    P.prepared(spark)
    rec = FX.event_record(FX.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type"))
    sent = parse_event_time("data.dt_current_timestamp")
    again = [rec.where(F.col("data._sequence_id") % 10 == digit).select(F.col("data").withField("dt_current_timestamp", F.date_format(sent + F.expr(f"INTERVAL {after}"), "yyyy-MM-dd HH:mm:ss.SSS")).alias("data"))
             for digit, after in ((3, "12 HOURS"), (7, "15 DAYS"))]
    messages = T.union_topics([rec, *again]).select(message_text(F.col("data")).alias("value"), _slice("data.dt_current_timestamp", 10, 4).cast("int").alias("delivery"))
    folder, deliver = _delivered(messages, "resent_events", 5, EVENT_BEAT)
    out, cp = session.fresh_path(spark, "streams", "without_resent"), C.checkpoint_for(spark, "without_resent")

    def start():
        rows = _event_stream(spark, folder).withColumn("sent_at", parse_event_time("dt_current_timestamp"))
        return C.start(ET.without_resent(rows, ["event_id"], "sent_at", "1 day"), f"without_resent_{out[-12:]}", cp, path=out, trigger="availableNow")

    _in_turns(start, [deliver], 5)
    return spark.read.parquet(out).select("event_id", "event_name", "event_timestamp")


@query("stream_event_sequence")
def stream_event_sequence(spark, sf):
    """Position of each event within its payment, numbered batch by batch; every eleventh event comes a delivery late and moves the others."""
    P.prepared(spark)
    late = _slice("ts", 10, 2) + F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    folder, deliver = _delivered(_event_messages(spark, sf, F.least(late, F.lit(2))), "sequence_events", 3, EVENT_BEAT)
    out, cp = session.fresh_path(spark, "tables", "sequence"), C.checkpoint_for(spark, "sequence")
    schemas = []

    def start():
        rows = _event_stream(spark, folder).where(F.col("event_id") != "beat").select("payment_id", "event_id", "event_name", "event_time")
        schemas.append(rows.schema)
        return C.start(rows, f"sequence_{out[-12:]}", cp, sink="foreachBatch", foreach_batch=SQ.SequenceWriter(out, BS.run_of(cp), every=2), trigger="availableNow")

    _in_turns(start, [deliver], 3)
    return SQ.read_sequence(spark, out, schemas[0]).select("payment_id", "event_id", "event_name", "seq", "out_of_order")


@query("stream_pattern_topics")
def stream_pattern_topics(spark, sf):
    """One running query over every topic that a pattern names: two folders appear while it runs, one of a topic nobody knows; another is not named."""
    P.prepared(spark)
    root, path = session.fresh_path(spark, "topics", "pattern"), session.fresh_path(spark, "tables", "pattern")
    cp = C.checkpoint_for(spark, "pattern")

    def publish(kind: str, topic: str) -> None:
        T.write_topic_folder(FX.topic_messages(spark, sf, kind), f"{root}/{topic}")

    publish("orders", FOLDER_TOPICS["orders"])
    q = BS.start_bronze_pattern(spark, root, "kafka-.*", path, name=f"pattern_{path[-12:]}", checkpoint=cp, trigger=None)
    try:
        q.processAllAvailable()
        publish("events", FOLDER_TOPICS["events"])
        publish("gps", "kafka-unknown")
        publish("gps", "other")
        q.processAllAvailable()
    finally:
        q.stop()
    rows = BS.read_bronze(spark, path)
    unknown = F.get_json_object("value", "$.data.gps_id")
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys"), F.countDistinct(unknown).alias("whole_lines"), F.countDistinct("partition", "offset").alias("offsets"))


@query("ext_position_at_event")
def ext_position_at_event(spark, sf):
    """Each payment event with the order's last position at that time; the positions of an order are its line items, spread over the month."""
    P.prepared(spark)
    li = FX.table(spark, sf, "lineitem")
    minute = (F.col("l_partkey") * 37 + F.col("l_suppkey") * 11 + F.col("l_linenumber") * 1009) % 41760
    points = li.select(F.concat(F.lit("pay-"), F.col("l_orderkey").cast("string")).alias("payment_id"), F.timestamp_seconds(F.lit(FIRST_SECOND) + minute * 60).alias("point_time"),
                       (F.col("l_partkey") % 1001).cast("long").alias("place"))
    events = S.events(P.bronze(spark, sf)).select("payment_id", "event_id", "event_time")
    return AO.as_of(events, points, "payment_id", "event_time", "point_time", ["place"]).select("payment_id", "event_id", "place")


@query("ext_order_gps_join")
def ext_order_gps_join(spark, sf):
    """Orders with their GPS points; a hot order is split at run time."""
    b = P.bronze(spark, sf)
    return E.order_gps(S.orders(b), S.gps(b))


@query("ext_payment_events_join")
def ext_payment_events_join(spark, sf):
    b = P.bronze(spark, sf)
    return E.payment_events(S.orders(b), S.events(b))
