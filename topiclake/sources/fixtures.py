"""The three linked topics, projected deterministically from the driver's tables.

``orders`` → kafka-orders and kafka-gps (one GPS point per order, linked by
``order_id = order_key``); ``events`` → kafka-events (``payment_id`` points at
an order's payment).  Pure column expressions: no random values, no loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.functions.envelope import message_text
from topiclake.functions.payload import event_time_text, last_digits, net_of, pick
from topiclake.schemas import FOLDER_TOPICS

# Payload domains.
CURRENCIES = ["BRL", "USD", "EUR"]
METHODS = ["Card", "Pix", "Boleto"]
CARD_BRANDS = ["Visa", "MasterCard", "Elo"]
ORDER_STATUS = {"F": "failed", "O": "pending"}  # anything else: succeeded
EVENT_NAMES = {"click": "created", "view": "authorized", "purchase": "captured", "signup": "succeeded"}
# any other event type: refunded

TABLES = ("orders", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _status(code: Column) -> Column:
    out = None
    for k, v in ORDER_STATUS.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise("succeeded")


def _event_name(kind: Column) -> Column:
    out = None
    for k, v in EVENT_NAMES.items():
        out = F.when(kind == k, v) if out is None else out.when(kind == k, v)
    return out.otherwise("refunded")


def order_fields() -> list[Column]:
    """Field expressions of a kafka-orders record over the ``orders`` table."""
    k = F.col("o_orderkey")
    ts = event_time_text("o_orderdate")
    ip = F.concat(
        F.lit("10.0."),
        (F.floor(k / 256).cast("bigint") % 256).cast("string"),
        F.lit("."),
        (k % 256).cast("string"),
    )
    return [
        k.alias("_sequence_id"),
        F.concat(F.lit("pay-"), k.cast("string")).alias("payment_id"),
        F.concat(F.lit("ord-"), k.cast("string")).alias("order_key"),
        F.col("o_totalprice").alias("amount"),
        pick(F.col("o_custkey"), CURRENCIES).alias("currency"),
        pick(k, METHODS).alias("method"),
        _status(F.col("o_orderstatus")).alias("status"),
        pick(F.col("o_custkey"), CARD_BRANDS).alias("card_brand"),
        last_digits(k).alias("card_last4"),
        net_of("o_totalprice").alias("net_amount"),
        F.lit("BR").alias("country"),
        ip.alias("ip_address"),
        ts.alias("timestamp"),
        ts.alias("dt_current_timestamp"),
    ]


def order_record(orders: DataFrame) -> DataFrame:
    """``data`` struct of kafka-orders, one per order."""
    return orders.select(F.struct(*order_fields()).alias("data"))


def event_record(events: DataFrame) -> DataFrame:
    """``data`` struct of kafka-events, one per event."""
    ts = event_time_text("ts")
    data = F.struct(
        F.col("event_id").alias("_sequence_id"),
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("pay-"), F.col("user_id").cast("string")).alias("payment_id"),
        F.struct(_event_name(F.col("event_type")).alias("event_name"), ts.alias("timestamp")).alias("event"),
        ts.alias("dt_current_timestamp"),
    )
    return events.select(data.alias("data"))


def gps_record(orders: DataFrame) -> DataFrame:
    """``data`` struct of kafka-gps, one point per order."""
    k = F.col("o_orderkey")
    ts = event_time_text("o_orderdate")
    data = F.struct(
        k.alias("_sequence_id"),
        F.concat(F.lit("gps-"), k.cast("string")).alias("gps_id"),
        F.concat(F.lit("ord-"), k.cast("string")).alias("order_id"),
        ((F.lit(-236000) + k % 1001).cast("double") / 10000).alias("lat"),
        ((F.lit(-467000) + (k * 7) % 1001).cast("double") / 10000).alias("lon"),
        (F.lit(10) + k % 51).cast("int").alias("speed_kph"),
        ((F.lit(50) + k % 451).cast("double") / 10).alias("accuracy_m"),
        ts.alias("timestamp"),
        ts.alias("dt_current_timestamp"),
    )
    return orders.select(data.alias("data"))


# Kafka message key of each topic: order_key for orders and GPS (so both
# land on the same partition), payment_id for events.
MESSAGE_KEY = {"orders": "order_key", "events": "payment_id", "gps": "order_id"}


def records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The ``data`` structs of topic ``kind`` (orders / events / gps)."""
    if kind == "orders":
        return order_record(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    if kind == "events":
        return event_record(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    if kind == "gps":
        return gps_record(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    raise ValueError(f"unknown topic kind {kind!r}")


def topic_messages(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Messages of a topic as they travel: ``key`` text, ``value`` JSON text, ``topic``."""
    rec = records(spark, sf_dir, kind)
    return rec.select(
        F.col(f"data.{MESSAGE_KEY[kind]}").alias("key"),
        message_text(F.col("data")).alias("value"),
        F.lit(FOLDER_TOPICS[kind]).alias("topic"),
    )
