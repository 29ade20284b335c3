"""Fixed message and table schemas (all fields nullable).

The three linked topics carry one JSON object per message with a single
member ``data``.  The folder variant of the topics adds ``_sequence_id``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Topic names as used by the Kafka variant and by the folder variant.
KAFKA_TOPICS = {"orders": "ordem", "events": "eventos", "gps": "gps"}
FOLDER_TOPICS = {"orders": "kafka-orders", "events": "kafka-events", "gps": "kafka-gps"}
PER_TOPIC_TABLES = {
    "orders": "kafka_bronze_ordem",
    "events": "kafka_bronze_eventos",
    "gps": "kafka_bronze_gps",
}
BRONZE_DATABASE = "bronze"
BRONZE_MULTIPLEX_TABLE = "kafka_multiplex"
KEY_PARTITIONS = 3
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def _s(name: str, dtype) -> StructField:
    return StructField(name, dtype, True)


def order_data(with_sequence: bool = True) -> StructType:
    fields = [
        _s("payment_id", StringType()),
        _s("order_key", StringType()),
        _s("amount", DoubleType()),
        _s("currency", StringType()),
        _s("method", StringType()),
        _s("status", StringType()),
        _s("card_brand", StringType()),
        _s("card_last4", StringType()),
        _s("net_amount", DoubleType()),
        _s("country", StringType()),
        _s("ip_address", StringType()),
        _s("timestamp", StringType()),
        _s("dt_current_timestamp", StringType()),
    ]
    return StructType(([_s("_sequence_id", LongType())] if with_sequence else []) + fields)


EVENT_DETAILS = StructType([_s("event_name", StringType()), _s("timestamp", StringType())])


def event_data(with_sequence: bool = True) -> StructType:
    fields = [
        _s("event_id", StringType()),
        _s("payment_id", StringType()),
        _s("event", EVENT_DETAILS),
        _s("dt_current_timestamp", StringType()),
    ]
    return StructType(([_s("_sequence_id", LongType())] if with_sequence else []) + fields)


def gps_data(with_sequence: bool = True) -> StructType:
    fields = [
        _s("gps_id", StringType()),
        _s("order_id", StringType()),
        _s("lat", DoubleType()),
        _s("lon", DoubleType()),
        _s("speed_kph", IntegerType()),
        _s("accuracy_m", DoubleType()),
        _s("timestamp", StringType()),
        _s("dt_current_timestamp", StringType()),
    ]
    return StructType(([_s("_sequence_id", LongType())] if with_sequence else []) + fields)


DATA_SCHEMAS = {"orders": order_data, "events": event_data, "gps": gps_data}


def envelope(kind: str, with_sequence: bool = True, corrupt_column: str | None = None) -> StructType:
    """``{"data": {...}}`` for topic ``kind``; optionally a ``_corrupt_record`` field."""
    fields = [_s("data", DATA_SCHEMAS[kind](with_sequence))]
    if corrupt_column:
        fields.append(_s(corrupt_column, StringType()))
    return StructType(fields)


def ddl(schema: StructType) -> str:
    """DDL string of a struct (``name TYPE, …``), as accepted by ``from_json``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# Kafka source record, as the Kafka source of Structured Streaming returns it.
KAFKA_RECORD = StructType(
    [
        _s("key", BinaryType()),
        _s("value", BinaryType()),
        _s("topic", StringType()),
        _s("partition", IntegerType()),
        _s("offset", LongType()),
        _s("timestamp", TimestampType()),
        _s("timestampType", IntegerType()),
    ]
)

# One table for all topics.
BRONZE_MULTIPLEX = StructType(
    [
        _s("key", LongType()),
        _s("value", StringType()),
        _s("topic", StringType()),
        _s("partition", IntegerType()),
        _s("offset", LongType()),
        _s("timestamp", TimestampType()),
        _s("ingestion_timestamp", TimestampType()),
    ]
)

# One table per topic, with all Kafka metadata.
BRONZE_PER_TOPIC = StructType(
    [
        _s("key", StringType()),
        _s("value", StringType()),
        _s("partition", IntegerType()),
        _s("offset", LongType()),
        _s("timestamp", TimestampType()),
        _s("timestampType", IntegerType()),
        _s("topic", StringType()),
        _s("bronze_ingestion_timestamp", TimestampType()),
    ]
)
