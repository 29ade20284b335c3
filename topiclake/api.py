"""Entry points for a deployment: your topic folders (or Kafka) in, bronze / silver / gold out.

```python
from topiclake import api
topics = {"orders": "/lake/kafka-orders", "events": "/lake/kafka-events", "gps": "/lake/kafka-gps"}
api.build_bronze(spark, topics, "/lake/bronze/kafka_multiplex")              # backfill, batch
q = api.stream_bronze(spark, topics, "/lake/bronze/kafka_multiplex",
                      checkpoint="/lake/_checkpoints/bronze", trigger="5 seconds")
orders = api.silver(spark, "/lake/bronze/kafka_multiplex", "orders")
api.gold(spark, "/lake/bronze/kafka_multiplex")["count_by_topic"].show()
```
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from topiclake import session
from topiclake.operators import bronze as B
from topiclake.operators import gold as G
from topiclake.operators import growth as GR
from topiclake.operators import silver as S
from topiclake.sources import topics as T
from topiclake.streaming import bronze_stream as BS


def read_topics(spark: SparkSession, topics: Mapping[str, str], mode: str = "batch", raw: bool = False,
                rescue_unknown: bool = False, **limits) -> dict:
    """``{kind: folder}`` → ``{kind: parsed frame}`` (``raw=True`` keeps the message line as ``value``)."""
    session.prepare(spark)
    if raw:
        return {k: T.read_topic_text(spark, k, p, mode, **limits) for k, p in topics.items()}
    return {k: T.read_topic(spark, k, path=p, mode=mode, rescue_unknown=rescue_unknown, **limits) for k, p in topics.items()}


def build_bronze(spark: SparkSession, topics: Mapping[str, str], out: str, keep_raw: bool = False,
                 time_from: str = "key", mode: str = "overwrite", rescue_unknown: bool = False) -> str:
    """Batch bronze multiplex of the topic folders written to ``out`` (Parquet by ``topic``).

    ``rescue_unknown`` keeps members the schema does not know (``_rescued``) and broken lines (``_corrupt_record``).
    """
    frames = read_topics(spark, topics, raw=keep_raw, rescue_unknown=rescue_unknown)
    table = B.multiplex(list(frames.values()), keep_raw=keep_raw, time_from=time_from)
    B.write_table(table, out, partition_by=("topic",), mode=mode)
    return out


def stream_bronze(spark: SparkSession, topics: Mapping[str, str], out: str, checkpoint: str,
                  trigger: str | None = "5 seconds", name: str = "bronze_multiplex", keep_raw: bool = False,
                  time_from: str = "key", table: str | None = None, rescue_unknown: bool = False, **limits) -> StreamingQuery:
    """The same bronze as a stream: exactly once, offsets continuing across micro-batches and runs.

    ``table`` (``database.table``) makes it readable by name in SQL; ``limits``
    (``max_files_per_trigger`` or ``max_bytes_per_trigger``) bound a micro-batch.
    """
    frames = read_topics(spark, topics, mode="stream", raw=keep_raw, rescue_unknown=rescue_unknown, **limits)
    return BS.start_bronze_stream(list(frames.values()), out, name=name, checkpoint=checkpoint, trigger=trigger,
                                  keep_raw=keep_raw, time_from=time_from, table=table)


def stream_bronze_pattern(spark: SparkSession, root: str, pattern: str, out: str, checkpoint: str, trigger: str | None = "5 seconds",
                          name: str = "bronze_pattern", kinds: Mapping[str, str] | None = None, table: str | None = None, **limits) -> StreamingQuery:
    """Bronze of every topic folder below ``root`` whose name matches ``pattern``, those that appear later included."""
    session.prepare(spark)
    return BS.start_bronze_pattern(spark, root, pattern, out, name, checkpoint, trigger, dict(kinds) if kinds else None, table, **limits)


def stream_bronze_from_kafka(spark: SparkSession, spec: T.TopicSpec, out: str, checkpoint: str,
                             trigger: str | None = "5 seconds", name: str = "kafka_bronze") -> StreamingQuery:
    """Per-topic bronze straight from a Kafka subscription (broker partitions and offsets kept)."""
    session.prepare(spark)
    return BS.start_kafka_bronze(spark, spec, out, name, checkpoint, trigger)


def bronze(spark: SparkSession, path: str) -> DataFrame:
    """A stored bronze table (batch-built or streamed); topic names stay text."""
    session.prepare(spark)
    found = spark.read.parquet(path)
    text = {f.name: "string" for f in found.schema.fields if f.name in ("topic", "_run")}
    schema = StructType([StructField(f.name, StringType()) if f.name in text else f for f in found.schema.fields])
    rows = spark.read.schema(schema).parquet(path)
    return BS.settled(rows, path) if "_run" in found.columns else rows


def typed_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze that was built with ``rescue_unknown``, its rescued members as columns of the least type that holds their values."""
    return GR.grown(bronze(spark, path))


def read_offsets(spark: SparkSession, path: str, topic: str, starting: Mapping[int, int], ending: Mapping[int, int] | None = None) -> DataFrame:
    """Rows of a streamed bronze between offsets per partition (end excluded), opening only the micro-batches that hold them."""
    session.prepare(spark)
    return BS.read_offsets(spark, path, topic, dict(starting), dict(ending or {}))


def compact(spark: SparkSession, path: str) -> int:
    """Merges the finished micro-batches of a streamed bronze; tables over it by name follow.  Returns how many were merged."""
    session.prepare(spark)
    return BS.compact(spark, path)


def silver(spark: SparkSession, bronze_path: str, kind: str, form: str | None = None) -> DataFrame:
    """Typed rows of one topic from bronze (``orders`` / ``events`` / ``gps``).

    ``form="message"`` for a multiplex table built with ``keep_raw``; per-topic tables are recognised by their columns.
    """
    return {"orders": S.orders, "events": S.events, "gps": S.gps}[kind](bronze(spark, bronze_path), form)


def gold(spark: SparkSession, bronze_path: str, form: str | None = None) -> dict[str, DataFrame]:
    """The gold questions over one bronze table, by name."""
    b = bronze(spark, bronze_path)
    orders, events, gps = S.orders(b, form), S.events(b, form), S.gps(b, form)
    return {
        "count_by_topic": G.count_by_topic(b),
        "partition_distribution": G.partition_distribution(b),
        "max_offset": G.max_offset(b),
        "total_rows": G.total_rows(b),
        "last_10": G.preview(b),
        "last_100_per_topic": G.last_per_topic(b),
        "orders_by_method": G.orders_by_method(orders),
        "avg_amount_by_status": G.avg_amount_by_status(orders),
        "status_summary": G.status_summary(orders),
        "event_sequence": S.event_sequence(events),
        "gps_points": S.gps_points(gps),
        "gps_count_by_speed": G.gps_count_by(gps, "speed_kph"),
    }
