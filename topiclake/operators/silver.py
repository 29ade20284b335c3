"""Silver: typed rows per topic, parsed once from bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.functions.envelope import parse
from topiclake.functions.payload import parse_event_time
from topiclake.operators.offsets import assign_offsets
from topiclake.schemas import DATA_SCHEMAS, FOLDER_TOPICS, KAFKA_TOPICS, ddl, envelope

META = ["key", "topic", "partition", "offset"]


def demux(bronze: DataFrame, kind: str) -> DataFrame:
    """Rows of one topic, under its folder or its Kafka name (partition pruning when the table is laid out by ``topic``)."""
    return bronze.where(F.col("topic").isin(FOLDER_TOPICS[kind], KAFKA_TOPICS[kind]))


def form_of(bronze: DataFrame) -> str:
    """What ``value`` holds: the whole message in tables with the Kafka metadata of the per-topic layout, else the record."""
    return "message" if "timestampType" in bronze.columns else "record"


def parse_value(bronze: DataFrame, kind: str, ddl_schema: bool = True, form: str | None = None) -> DataFrame:
    """Drop rows without payload, parse ``value`` once.

    ``form``: ``record`` (the record itself), ``message`` (the record in its
    envelope, as multiplex tables built with ``keep_raw`` have it); by default by the table's layout.
    """
    form = form or form_of(bronze)
    if form not in ("record", "message"):
        raise ValueError(f"form must be 'record' or 'message', not {form!r}")
    schema = DATA_SCHEMAS[kind](True) if form == "record" else envelope(kind)
    record = parse("value", ddl(schema) if ddl_schema else schema)
    record = record if form == "record" else record.getField("data")
    rows = bronze.where(F.col("value").isNotNull())
    return rows.select(*[c for c in META if c in rows.columns], record.alias("r"))


def orders(bronze: DataFrame, form: str | None = None) -> DataFrame:
    rows = parse_value(demux(bronze, "orders"), "orders", form=form)
    return rows.select(*[c for c in META if c in rows.columns], "r.*").withColumn(
        "order_time", parse_event_time("timestamp")
    )


def events(bronze: DataFrame, form: str | None = None) -> DataFrame:
    """Event rows with the nested event flattened: ``event_name``, ``event_timestamp``."""
    rows = parse_value(demux(bronze, "events"), "events", form=form)
    return rows.select(
        *[c for c in META if c in rows.columns],
        F.col("r._sequence_id").alias("_sequence_id"),
        F.col("r.event_id").alias("event_id"),
        F.col("r.payment_id").alias("payment_id"),
        F.col("r.event.event_name").alias("event_name"),
        F.col("r.event.timestamp").alias("event_timestamp"),
        F.col("r.dt_current_timestamp").alias("dt_current_timestamp"),
    ).withColumn("event_time", parse_event_time("event_timestamp"))


def gps(bronze: DataFrame, form: str | None = None) -> DataFrame:
    rows = parse_value(demux(bronze, "gps"), "gps", form=form)
    return rows.select(*[c for c in META if c in rows.columns], "r.*").withColumn(
        "point_time", parse_event_time("timestamp")
    )


def event_sequence(events_df: DataFrame, method: str = "split", leaf_rows: int | None = None) -> DataFrame:
    """Position (from 1) of each event within its payment, by event time; event id breaks ties.

    ``method="window"`` is ``row_number() OVER (PARTITION BY payment_id ORDER BY …)``;
    the default splits a payment with very many events over several tasks.
    """
    out = assign_offsets(events_df, groups=("payment_id",), order=(parse_event_time("event_timestamp"), "event_id"),
                         column="seq", method=method, leaf_rows=leaf_rows, many_groups=True)
    return out.withColumn("seq", (F.col("seq") + 1).cast("int"))


def gps_points(gps_df: DataFrame) -> DataFrame:
    """The data behind a map: coordinates and speed."""
    return gps_df.select("lat", "lon", "speed_kph")
