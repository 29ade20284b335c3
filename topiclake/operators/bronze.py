"""Bronze: raw messages with (simulated) Kafka metadata, append-only.

* multiplex table — all topics in one table: key, value, topic, partition,
  offset, timestamp, ingestion_timestamp;
* per-topic tables — key, value, partition, offset, timestamp,
  timestampType, topic, bronze_ingestion_timestamp.

Offsets count per (topic, partition), from 0, ordered by key; records with
the same key are ordered by a 64-bit hash of their value, then by source
position (only copies of one record, or a hash collision, get that far).
Every sort key is fixed-width, so the range sampling that Spark collects on
the driver holds no message text.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake import session
from topiclake.functions.envelope import CORRUPT, RESCUED
from topiclake.functions.keys import key_partition, key_time, message_partition
from topiclake.functions.payload import parse_event_time
from topiclake.operators.offsets import assign_offsets
from topiclake.schemas import KEY_PARTITIONS

MULTIPLEX_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "ingestion_timestamp"]
PER_TOPIC_COLUMNS = ["key", "value", "partition", "offset", "timestamp", "timestampType", "topic", "bronze_ingestion_timestamp"]


def bronze_rows(
    parsed: DataFrame,
    keep_raw: bool = False,
    time_from: str = "key",
    partitions: int = KEY_PARTITIONS,
) -> DataFrame:
    """Parsed topic rows (``data``, ``_topic_name``[, raw ``value``]) → key, value, topic, partition, timestamp.

    ``value`` is ``to_json(data)`` (envelope removed, NULL and unknown members
    dropped) unless ``keep_raw``, which keeps the untouched message line.
    ``timestamp`` is epoch + key seconds (``time_from="key"``) or the payload's
    own ``dt_current_timestamp`` (``time_from="payload"``).
    """
    key = F.col("data._sequence_id").cast("long")
    value = F.col("value") if keep_raw else F.to_json(F.col("data"))
    if not keep_raw and CORRUPT in parsed.columns:  # nothing of a broken line is lost
        value = F.coalesce(F.col(CORRUPT), value)
    if time_from == "key":
        ts = key_time(key)
    elif time_from == "payload":
        ts = parse_event_time(F.col("data.dt_current_timestamp"))
    else:
        raise ValueError(f"time_from must be 'key' or 'payload', not {time_from!r}")
    extra = [c for c in parsed.columns if c.startswith("_tl_") or c in (RESCUED, CORRUPT)]
    return parsed.select(
        key.alias("key"),
        value.cast("string").alias("value"),
        F.col("_topic_name").cast("string").alias("topic"),
        key_partition(key, partitions).alias("partition"),
        ts.alias("timestamp"),
        *extra,
    )


def pattern_rows(found: DataFrame, partitions: int = KEY_PARTITIONS) -> DataFrame:
    """Rows of :func:`topics.read_pattern` → the columns of :func:`bronze_rows`; a line of an unknown topic, or one that
    does not parse, is the value as it came."""
    return found.select(
        "key",
        F.coalesce(F.col("record"), F.col("value")).alias("value"),
        F.col("_topic_name").alias("topic"),
        key_partition(F.col("key"), partitions).alias("partition"),
        key_time(F.col("key")).alias("timestamp"),
    )


def finish(rows: DataFrame, ingestion: str = "ingestion_timestamp") -> DataFrame:
    """Cast to the multiplex schema and stamp the ingestion time (constant per query / micro-batch).

    The rescued members and the text of broken lines, where the topics were read with them, are kept.
    """
    return rows.select(
        F.col("key").cast("long"),
        F.col("value").cast("string"),
        F.col("topic").cast("string"),
        F.col("partition").cast("int"),
        F.col("offset").cast("long"),
        F.col("timestamp").cast("timestamp"),
        F.current_timestamp().alias(ingestion),
        *[c for c in (RESCUED, CORRUPT) if c in rows.columns],
    )


def multiplex(
    parsed_topics: Sequence[DataFrame],
    keep_raw: bool = False,
    time_from: str = "key",
    partitions: int = KEY_PARTITIONS,
    method: str = "split",
    leaf_rows: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Union the topics by name and give every row its offset (bronze multiplex rows)."""
    rows = None
    for t in parsed_topics:
        r = bronze_rows(t, keep_raw, time_from, partitions)
        rows = r if rows is None else rows.unionByName(r, allowMissingColumns=True)
    rows = assign_offsets(rows, order=multiplex_order(), method=method, leaf_rows=leaf_rows, base=base)
    return finish(rows)


def multiplex_from_kafka(records: DataFrame) -> DataFrame:
    """Bronze multiplex rows out of Kafka records (text key and value, broker metadata).

    ``key`` is the record's ``_sequence_id``, or else the message key where it is a
    number; ``message_key`` keeps the message key as it came.  Partition, offset and time are the
    broker's; ``value`` is the record without its envelope.
    """
    return records.select(
        F.coalesce(F.expr("try_cast(get_json_object(value, '$.data._sequence_id') AS BIGINT)"), F.expr("try_cast(key AS BIGINT)")).alias("key"),
        F.coalesce(F.get_json_object("value", "$.data"), F.col("value")).alias("value"),
        "topic", "partition", "offset", "timestamp",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col("key").alias("message_key"),
    )


def kafka_records(parsed: DataFrame, message_key: str, keep_raw: bool = True, partitions: int = KEY_PARTITIONS,
                  method: str = "split", leaf_rows: int | None = None) -> DataFrame:
    """Kafka-shaped records of one topic read from files: the metadata Kafka would add.

    key = the message key (text), partition = a hash of the message key, so all
    messages of a key share one; offset per partition in ``_sequence_id`` order, timestamp = the payload's
    send time (CreateTime, timestampType 0).
    """
    rows = kafka_rows(parsed, message_key, keep_raw, partitions)
    rows = assign_offsets(rows, groups=("topic", "partition"), order=kafka_order(), method=method, leaf_rows=leaf_rows)
    return rows.drop("_seq")


def multiplex_order() -> tuple:
    """Order of records within a topic partition of the multiplex table."""
    return ("key", F.xxhash64("value"))


def kafka_order() -> tuple:
    """Kafka-shaped records follow the producer's sequence, then a hash of key and value."""
    return ("_seq", F.xxhash64("key", "value"))


def kafka_rows(parsed: DataFrame, message_key: str, keep_raw: bool = True,
               partitions: int = KEY_PARTITIONS) -> DataFrame:
    """The metadata of :func:`kafka_records` without offsets (``_seq`` kept for their order)."""
    seq = F.col("data._sequence_id").cast("long")
    value = F.col("value") if keep_raw and "value" in parsed.columns else F.to_json(F.struct(F.col("data").alias("data")))
    return parsed.select(
        F.col(f"data.{message_key}").cast("string").alias("key"),
        value.cast("string").alias("value"),
        F.col("_topic_name").alias("topic"),
        message_partition(F.col(f"data.{message_key}"), partitions).alias("partition"),
        parse_event_time(F.col("data.dt_current_timestamp")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        seq.alias("_seq"),
    )


def per_topic(records: DataFrame) -> DataFrame:
    """Kafka records → per-topic bronze schema with ``bronze_ingestion_timestamp``."""
    return records.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        F.col("partition").cast("int"),
        F.col("offset").cast("long"),
        F.col("timestamp").cast("timestamp"),
        F.col("timestampType").cast("int"),
        F.col("topic").cast("string"),
        F.current_timestamp().alias("bronze_ingestion_timestamp"),
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("topic",), mode: str = "append",
                merge_schema: bool = False) -> None:
    """Path-based Parquet table, partitioned for pruning (``topic`` by default)."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    w.parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    r = spark.read
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.parquet(path)


def register(spark: SparkSession, database: str, table: str, path: str) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` + an external table over ``path``; returns ``db.table``.

    Partitions of the folder layout are discovered with ``MSCK REPAIR TABLE``.
    """
    full = f"`{database}`.`{table}`"
    with _CATALOG_LOCK:  # drop + create is not atomic: one registration at a time
        session.ensure_database(spark, database)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} USING parquet LOCATION '{path}'")
        try:
            spark.sql(f"MSCK REPAIR TABLE {full}")
        except Exception:  # unpartitioned table
            pass
    return f"{database}.{table}"


_CATALOG_LOCK = threading.RLock()


def read_offset_range(bronze: DataFrame, topic: str, starting: dict | str = "earliest",
                      ending: dict | str = "latest") -> DataFrame:
    """Rows of ``topic`` between starting and ending offsets, per partition.

    ``starting`` / ``ending`` are ``"earliest"`` / ``"latest"`` or a map
    ``{partition: offset}`` (start inclusive, end exclusive, as Kafka reads);
    a partition that a map does not name is not bounded by it.
    """
    rows = bronze.where(F.col("topic") == topic)
    for bounds, inside in ((starting, lambda off: F.col("offset") >= off), (ending, lambda off: F.col("offset") < off)):
        for p, off in bounds.items() if isinstance(bounds, dict) else ():
            rows = rows.where((F.col("partition") != p) | inside(off))
    return rows
