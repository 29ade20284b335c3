"""Building blocks shared by the registered queries: topics, bronze, silver of one data set.

The medallion layout as a deployment would have it: topic folders are written
once from the tables, the bronze multiplex and the per-topic bronze tables are
built once from the topic folders and stored as Parquet under the shared
folder (partitioned by ``topic``); gold queries read those tables, so they
scan only the columns and topics they use.  The build steps themselves are
registered queries too (``bronze_batch``, ``assign_offsets``, the streams).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from topiclake import session
from topiclake.operators import bronze as B
from topiclake.operators import silver as S
from topiclake.sources import topics as T
from topiclake.sources.fixtures import MESSAGE_KEY

KINDS = ("orders", "events", "gps")
# Bumped when the stored layout changes, so older stored tables are not reused.
LAYOUT_VERSION = "v3"


def prepared(spark: SparkSession) -> SparkSession:
    return session.prepare(spark)


def topic_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    return T.topic_folder(spark, sf_dir, kind)


def parsed_topic(spark: SparkSession, sf_dir: str, kind: str, mode: str = "batch") -> DataFrame:
    """Topic ``kind`` read from its JSON folder with the fixed envelope schema."""
    prepared(spark)
    return T.read_topic(spark, kind, path=topic_path(spark, sf_dir, kind), mode=mode, backend="files")


def build_bronze(spark: SparkSession, sf_dir: str, kinds=KINDS, method: str = "split", time_from: str = "key",
                 leaf_rows: int | None = None) -> DataFrame:
    """Batch bronze multiplex of the topics, computed (all rows, offsets per topic and partition)."""
    prepared(spark)
    return B.multiplex([parsed_topic(spark, sf_dir, k) for k in kinds], method=method, time_from=time_from,
                       leaf_rows=leaf_rows)


_BUILD_LOCK = threading.RLock()  # re-entrant: a stored table may build another


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    path = session.shared_path(spark, "tables", T._fingerprint(spark, sf_dir) + "-" + LAYOUT_VERSION, name)
    if session.path_exists(spark, f"{path}/_SUCCESS"):
        return path
    with _BUILD_LOCK:  # one builder per table when queries run from several threads
        if not session.path_exists(spark, f"{path}/_SUCCESS"):
            B.write_table(build(), path, partition_by=("topic",), mode="overwrite")
    return path


def bronze_path(spark: SparkSession, sf_dir: str) -> str:
    """Stored bronze multiplex of the three topics (built on first use)."""
    return _stored(spark, sf_dir, "kafka_multiplex", lambda: build_bronze(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bronze multiplex, columns in schema order (``topic`` is the folder partition)."""
    prepared(spark)
    return spark.read.parquet(bronze_path(spark, sf_dir)).select(*B.MULTIPLEX_COLUMNS)


def message_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The raw lines of a topic with their parsed envelope."""
    prepared(spark)
    return T.read_topic_text(spark, kind, topic_path(spark, sf_dir, kind))


def kafka_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Kafka-shaped records (text key, raw value line, partition, offset, …) of one topic, computed."""
    return B.kafka_records(message_lines(spark, sf_dir, kind), MESSAGE_KEY[kind], keep_raw=True)


def per_topic_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    from topiclake.schemas import PER_TOPIC_TABLES

    return _stored(spark, sf_dir, PER_TOPIC_TABLES[kind],
                   lambda: B.per_topic(kafka_records(spark, sf_dir, kind)))


def per_topic_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(per_topic_path(spark, sf_dir, kind)).select(*B.PER_TOPIC_COLUMNS)


SILVER = {"orders": S.orders, "events": S.events, "gps": S.gps}


def silver(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Silver rows of one topic, parsed once from the stored bronze value."""
    return SILVER[kind](bronze(spark, sf_dir))
