"""Topic sources: one API for batch and stream, Kafka or JSON folders.

``backend="kafka"`` builds the Structured Streaming Kafka source (the
connector jar must be on the classpath).  ``backend="files"`` reads a folder
of JSON messages, one message per line, with an explicit schema and no
inference; it stands in for Kafka where no broker exists.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topiclake import session
from topiclake.functions.envelope import CORRUPT, RESCUED, parse, rescue
from topiclake.schemas import FOLDER_TOPICS, envelope

# Kafka client timeouts that stop a consumer group from rebalancing
# in a loop over a slow link; pass as ``TopicSpec(client=REBALANCE_TIMEOUTS)``.
REBALANCE_TIMEOUTS = {
    "kafka.session.timeout.ms": "30000",
    "kafka.request.timeout.ms": "40000",
    "kafka.heartbeat.interval.ms": "3000",
}


@dataclass
class TopicSpec:
    """What to read.  ``topics`` → ``subscribe`` (comma list); ``pattern`` → ``subscribePattern``."""

    topics: Sequence[str] = ()
    pattern: str | None = None
    bootstrap_servers: str | None = None
    starting_offsets: str | None = None  # "earliest" | "latest" | JSON; None = source default
    ending_offsets: str | None = None  # batch only
    fail_on_data_loss: bool | None = None
    client: Mapping[str, str] = field(default_factory=dict)


def kafka_options(spec: TopicSpec, batch: bool = False) -> dict[str, str]:
    """Option map of the Kafka source for ``spec``."""
    if bool(spec.topics) == bool(spec.pattern):
        raise ValueError("give exactly one of topics or pattern")
    opts: dict[str, str] = {}
    if spec.bootstrap_servers:
        opts["kafka.bootstrap.servers"] = spec.bootstrap_servers
    if spec.topics:
        opts["subscribe"] = ",".join(spec.topics)
    else:
        opts["subscribePattern"] = spec.pattern
    if spec.starting_offsets is not None:
        opts["startingOffsets"] = spec.starting_offsets
    if batch and spec.ending_offsets is not None:
        opts["endingOffsets"] = spec.ending_offsets
    if spec.fail_on_data_loss is not None:
        opts["failOnDataLoss"] = "true" if spec.fail_on_data_loss else "false"
    for k, v in spec.client.items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return opts


def read_kafka(spark: SparkSession, spec: TopicSpec, mode: str = "stream") -> DataFrame:
    """Kafka records (binary key/value + metadata), bounded or unbounded."""
    batch = mode == "batch"
    reader = spark.read if batch else spark.readStream
    return reader.format("kafka").options(**kafka_options(spec, batch=batch)).load()


def records_as_text(kafka_df: DataFrame) -> DataFrame:
    """``CAST(key AS STRING)``, ``CAST(value AS STRING)`` plus the metadata."""
    return kafka_df.selectExpr(
        "CAST(key AS STRING) AS key",
        "CAST(value AS STRING) AS value",
        "topic",
        "partition",
        "offset",
        "timestamp",
        "timestampType",
    )


# ----------------------------------------------------------------- files


def admission(mode: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None) -> dict[str, str]:
    """Options that bound a micro-batch of a folder stream, by files or by bytes (one of the two)."""
    if mode == "batch":
        return {}
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("give max_files_per_trigger or max_bytes_per_trigger, not both")
    both = {"maxFilesPerTrigger": max_files_per_trigger, "maxBytesPerTrigger": max_bytes_per_trigger}
    return {k: str(v) for k, v in both.items() if v}


def read_folder(
    spark: SparkSession,
    path: str,
    schema: StructType,
    topic: str | None = None,
    mode: str = "batch",
    max_files_per_trigger: int | None = None,
    with_file: bool = False,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """A folder of JSON messages with a fixed schema (no inference), recursive lookup.

    ``topic`` adds ``_topic_name``; ``with_file`` adds ``_file``, the file each row came from.
    """
    reader = spark.read if mode == "batch" else spark.readStream
    reader = reader.schema(schema).option("recursiveFileLookup", "true").option("mode", "PERMISSIVE")
    reader = reader.options(**admission(mode, max_files_per_trigger, max_bytes_per_trigger))
    df = reader.json(path)
    if with_file:
        df = df.withColumn("_file", F.col("_metadata.file_path"))
    if topic is not None:
        df = df.withColumn("_topic_name", F.lit(topic))
    return df


def read_folder_text(
    spark: SparkSession,
    path: str,
    topic: str | None = None,
    mode: str = "batch",
    max_files_per_trigger: int | None = None,
    with_file: bool = False,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The untouched message lines of a folder as ``value`` (plus ``_topic_name``, optionally ``_file``)."""
    reader = spark.read if mode == "batch" else spark.readStream
    reader = reader.option("recursiveFileLookup", "true")
    reader = reader.options(**admission(mode, max_files_per_trigger, max_bytes_per_trigger))
    df = reader.format("text").load(path)
    if with_file:
        df = df.withColumn("_file", F.col("_metadata.file_path"))
    if topic is not None:
        df = df.withColumn("_topic_name", F.lit(topic))
    return df


def read_with_rescue(
    spark: SparkSession, path: str, kind: str, topic: str | None = None, mode: str = "batch", **limits
) -> DataFrame:
    """Parsed messages plus ``_rescued`` (unknown members of ``data``) and ``_corrupt_record``.

    Read as text once; both parses run on the same line, so no field is lost.
    """
    env = envelope(kind, corrupt_column=CORRUPT)
    text = read_folder_text(spark, path, topic, mode, **limits)
    parsed = text.select(
        "*",
        parse(F.col("value"), env, corrupt=True).alias("_msg"),
        rescue(F.col("value"), env["data"].dataType).alias(RESCUED),
    )
    return parsed.select("_msg.data", F.col(f"_msg.{CORRUPT}").alias(CORRUPT), RESCUED, *[c for c in text.columns if c != "value"])


def read_topic(
    spark: SparkSession,
    kind: str,
    path: str | None = None,
    spec: TopicSpec | None = None,
    mode: str = "batch",
    backend: str = "files",
    rescue_unknown: bool = False,
    **limits,
) -> DataFrame:
    """Parsed envelope of topic ``kind`` with ``_topic_name``.

    files: ``path`` is the topic folder; ``rescue_unknown`` adds unknown members
    and broken lines (:func:`read_with_rescue`); ``limits``: :func:`admission`.
    kafka: ``spec`` names the topic; the value is parsed with the same envelope
    schema and the broker's key, partition, offset and time are kept
    (``bronze.multiplex_from_kafka`` takes the records as they are).
    """
    topic = FOLDER_TOPICS[kind]
    if backend == "files":
        if rescue_unknown:
            return read_with_rescue(spark, path, kind, topic, mode, **limits)
        return read_folder(spark, path, envelope(kind), topic, mode, **limits)
    if backend == "kafka":
        raw = records_as_text(read_kafka(spark, spec, mode))
        return raw.select(
            "key",
            parse("value", envelope(kind)).getField("data").alias("data"),
            F.col("topic").alias("_topic_name"),
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
        )
    raise ValueError(f"unknown backend {backend!r}")


def read_topic_text(spark: SparkSession, kind: str, path: str, mode: str = "batch", **limits) -> DataFrame:
    """Untouched message line (``value``) with its parsed envelope (``data``) and ``_topic_name``.

    The input of bronze with ``keep_raw=True``: the stored value is the line as it arrived.
    """
    text = read_folder_text(spark, path, FOLDER_TOPICS[kind], mode, **limits)
    return text.select("value", parse("value", envelope(kind)).getField("data").alias("data"), "_topic_name")


def read_pattern(spark: SparkSession, root: str, pattern: str, kinds: Mapping[str, str] | None = None, mode: str = "stream",
                 **limits) -> DataFrame:
    """Every topic below ``root`` whose name matches ``pattern`` (a regular expression on the whole name), in one frame.

    A topic is a folder below ``root``; new ones are found while the query runs, as Kafka's ``subscribePattern`` finds
    them.  ``kinds`` maps topic names to record kinds (by default the known folder topics); their lines are parsed by their own
    schema.  Lines of other topics are kept whole.  Columns: ``_topic_name``, ``_kind`` (null for an unknown topic), ``value`` (the
    untouched line), ``key`` (the record's sequence) and ``record`` (the record as JSON), both null where there is none.
    """
    kinds = dict(kinds) if kinds is not None else {name: kind for kind, name in FOLDER_TOPICS.items()}
    base = session.file_system(spark, root)[1].toUri().getPath().rstrip("/")
    text = read_folder_text(spark, root, None, mode, with_file=True, **limits)
    name = F.regexp_extract("_file", f"\\Q{base}\\E/+([^/]+)/", 1)
    rows = text.select("value", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("_topic_name"))
    rows = rows.where(F.col("_topic_name").rlike(f"^(?:{pattern})$"))
    key, record, known = (F.lit(None).cast(t) for t in ("long", "string", "string"))
    for topic, kind in kinds.items():
        mine = F.col("_topic_name") == topic
        data = parse(F.when(mine, F.col("value")), envelope(kind)).getField("data")
        key = F.coalesce(data.getField("_sequence_id").cast("long"), key)
        record = F.coalesce(F.to_json(data), record)
        known = F.when(mine, kind).otherwise(known)
    return rows.select("_topic_name", known.alias("_kind"), "value", key.alias("key"), record.alias("record"))


def union_topics(frames: Sequence[DataFrame]) -> DataFrame:
    """Several topics in one frame, by column name (duplicates kept, no shuffle)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ------------------------------------------------- topic folders from tables


_FOLDER_LOCK = threading.RLock()
# Messages of a file at most: a compressed file is read by one task.
RECORDS_PER_FILE = 500_000


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names the inputs by path, size and time of their files, read through their own file system."""
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    for name in ("orders", "events"):
        h.update(repr(session.file_stamps(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")).encode())
    return h.hexdigest()[:16]


def topic_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Folder of topic ``kind`` written from the tables under ``sf_dir`` (written once, then reused)."""
    from topiclake.sources.fixtures import topic_messages

    path = session.shared_path(spark, "topics", _fingerprint(spark, sf_dir), FOLDER_TOPICS[kind])
    if session.path_exists(spark, f"{path}/_SUCCESS"):
        return path
    with _FOLDER_LOCK:  # one writer per folder when queries run from several threads
        if not session.path_exists(spark, f"{path}/_SUCCESS"):
            write_topic_folder(topic_messages(spark, sf_dir, kind), path, RECORDS_PER_FILE)
    return path


def write_topic_folder(messages: DataFrame, path: str, records_per_file: int | None = None, mode: str = "overwrite") -> None:
    """One JSON message per line, snappy files, as the member names repeat in every line; ``records_per_file=1`` gives one document per file."""
    w = messages.select("value").write.mode(mode).option("compression", "snappy")
    if records_per_file:
        w = w.option("maxRecordsPerFile", str(records_per_file))
    w.text(path)


def in_files(messages: DataFrame, files: int, kept: Column | None = None) -> DataFrame:
    """``messages`` (those ``kept``) in ``files`` partitions, so that they are written as that many files: partitions that are there are put
    together, without a shuffle; messages that lie in too few of them for that are dealt anew."""
    filled = messages.select(F.spark_partition_id().alias("at")).distinct().count()
    empty = messages.rdd.getNumPartitions() - filled
    rows = messages if kept is None else messages.where(kept)
    return rows.coalesce(files) if empty < (filled + empty) // files else rows.repartition(files)


def write_topic_files(messages: DataFrame, path: str, number: str, records_per_file: int) -> None:
    """Messages in files of ``records_per_file`` each, the last with the rest: file i holds those whose ``number`` (0, 1, 2, …)
    is in [i, i + 1) times that.  One task writes a file, so files are written in parallel and hold the same records every time.
    """
    file = F.floor(F.col(number) / records_per_file)
    rows = messages.select("value", file.alias("file"))
    rows.repartition("file").sortWithinPartitions("file").write.partitionBy("file").text(path)


def write_topic_records(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Keyed records of several topics into ``path/topic=<name>/`` as JSON lines (key, value)."""
    messages.select("key", "value", "topic").write.mode(mode).partitionBy("topic").json(path)


def kafka_writer(messages: DataFrame, spec: TopicSpec, mode: str = "batch"):
    """Writer of keyed records (``key``, ``value``, ``topic``) to Kafka: ``.save()`` it, or ``.start()`` it for a stream."""
    frame = messages.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic")
    writer = (frame.write if mode == "batch" else frame.writeStream).format("kafka")
    return writer.options(**kafka_sink_options(spec))


def kafka_sink_options(spec: TopicSpec) -> dict[str, str]:
    """Option map of the Kafka sink: servers and client settings; each record names its topic."""
    if not spec.bootstrap_servers:
        raise ValueError("the sink needs bootstrap_servers")
    client = {k if k.startswith("kafka.") else f"kafka.{k}": str(v) for k, v in spec.client.items()}
    return {"kafka.bootstrap.servers": spec.bootstrap_servers, **client}
