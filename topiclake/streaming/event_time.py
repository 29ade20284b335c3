"""Event-time operators on streams: joins of two topics, resent messages, sessions, windows and the rows that miss them.

All of them need a watermark, and end their state by it.  A topic that falls silent holds its watermark, and
so the state and the output of everything joined with it; a beat is the row, at ``BEAT`` or later, that a producer sends to say that nothing older
will come, and ``after_beats`` takes such rows out once the watermark has seen them.  A beat has values where the query
asks for any (its join key, its id), as Spark filters nulls out below the watermark.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# Rows of this time or later only move the watermark.
BEAT = "9000-01-01 00:00:00"
_WHOLE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def after_beats(df: DataFrame, time: str, delay: str) -> DataFrame:
    """``df`` under a watermark of ``delay`` on ``time``, without rows that have no time and without beats.

    The filter looks at the time itself, so it stays above the watermark, which sees the beats.
    """
    return df.withWatermark(time, delay).where(F.col(time) < F.lit(BEAT).cast("timestamp"))


# ------------------------------------------------------------------ joins

# Messages of all deliveries that a state partition is made for; each has a state store, opened at every start and committed with every micro-batch.
STATE_MESSAGES = 200_000


def join_state(spark: SparkSession, messages: int) -> dict[str, str]:
    """Settings to start a stream-stream join of about ``messages`` messages under, if it comes in few large micro-batches with restarts between them.

    A partition's four tables are in one RocksDB store, and there are no more partitions than the messages need (never more than the
    session's).  The state's files are stored with each micro-batch: a log of changes would hold every row that ever came, and a restart
    would put them all in again.
    """
    most, least = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    return {"spark.sql.streaming.join.stateFormatVersion": "3",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
            "spark.sql.shuffle.partitions": str(min(most, max(least, -(-messages // STATE_MESSAGES))))}


def left_join_in_time(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, within: str,
                      delay: str = "10 minutes") -> DataFrame:
    """Every ``left`` row with each ``right`` row of its key at or after its time and at most ``within`` later; left outer.

    Both sides are held as state: a left row until the right side's watermark has passed its time + ``within`` (then it goes out
    alone if it found nothing), a right row until no left row can still come that reaches it.  Columns other
    than ``on`` must differ.
    """
    l = after_beats(left, left_time, delay)  # noqa: E741
    r = after_beats(right, right_time, delay).withColumnRenamed(on, f"_r_{on}")
    near = (F.col(on) == F.col(f"_r_{on}")) & (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    return l.join(r, near, "left_outer").drop(f"_r_{on}")


# ------------------------------------------------------------------ resent messages


def without_resent(df: DataFrame, ids: Sequence[str], sent: str, delay: str) -> DataFrame:
    """One row per message id: a message sent again within ``delay`` of the first is dropped, whichever micro-batch it comes in.

    State is one row per id sent within ``delay`` of the watermark, so it doesn't grow with the topic; what is sent
    again later than that is a new message.
    """
    return after_beats(df, sent, delay).dropDuplicatesWithinWatermark(list(ids))


# ------------------------------------------------------------------ sessions


def stream_sessions(df: DataFrame, by: str, time: str, gap: str, delay: str) -> DataFrame:
    """(``by``, session_start, session_end, n) of each session, once the watermark has passed its end.

    Sessions of a key that a later row joins up are merged in state across micro-batches; for rows no later
    than ``delay`` the result is the batch sessions, however the input is split.
    """
    g = after_beats(df, time, delay).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


# ------------------------------------------------------------------ windows and late rows


class _Closing(StatefulProcessor):
    """One (key, window): counts rows until the timer at its end fires; rows that come after the watermark passed the end are handed on."""

    def __init__(self, size_ms: int):
        self.size = size_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.n = handle.getValueState("n", StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start = int(key[1])
        end, clock = start + self.size, timerValues.getCurrentWatermarkInMs()
        added = 0
        for part in rows:
            if end <= clock:
                yield pd.DataFrame({"kind": "late", "key": key[0], "start": start, "n": 1, "row": part["row"].to_numpy()})
            else:
                added += len(part)
        if added:
            known = self.n.get() if self.n.exists() else None
            if known is None:
                self.handle.registerTimer(end)
            self.n.update((added + (known[0] if known else 0),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n = self.n.get()[0]
        self.n.clear()
        yield pd.DataFrame({"kind": ["window"], "key": [key[0]], "start": [int(key[1])], "n": [n], "row": [None]})

    def close(self) -> None:
        pass


_CLOSED = StructType([StructField("kind", StringType()), StructField("key", StringType()), StructField("start", LongType()),
                      StructField("n", LongType()), StructField("row", StringType())])


def windows_and_late(df: DataFrame, by: str, time: str, size_seconds: int, delay: str, salts: int = 1) -> DataFrame:
    """Tumbling counts and the rows that came too late for theirs, in one stream.

    ``kind = 'window'``: (key, window_start, window_end, n), once the watermark has passed the end.  ``kind = 'late'``: a row whose
    window had been closed by the watermark of earlier micro-batches, whole in ``row`` (a struct).  Every row with a time is in
    exactly one of them.  ``by`` becomes text.  ``salts`` over one spreads a hot window over so many tasks; its count then comes in as
    many rows, to be added up.
    """
    clean = after_beats(df, time, delay)
    size = size_seconds * 1000
    at = F.floor(F.unix_micros(time) / 1000)
    # The watermark's column is left behind: its operator would drop late rows before they could be told.
    rows = clean.select(F.col(by).cast("string").alias("key"), (at - F.pmod(at, F.lit(size))).alias("start"),
                        F.pmod(F.xxhash64(*clean.columns), F.lit(salts)).alias("salt"),
                        F.to_json(F.struct(*clean.columns), {"timestampFormat": _WHOLE, "ignoreNullFields": "false"}).alias("row"))
    closed = rows.groupBy("key", "start", "salt").transformWithStateInPandas(_Closing(size), _CLOSED, "append", "EventTime")
    whole = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return closed.select("kind", "key", F.timestamp_millis("start").alias("window_start"), F.timestamp_millis(F.col("start") + size).alias("window_end"),
                         "n", F.from_json("row", whole, {"timestampFormat": _WHOLE}).alias("row"))


class WindowSink:
    """``foreachBatch`` of :func:`windows_and_late`: ``path/kind=window|late/_batch_id=…``; a replayed batch overwrites its own folders."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "_batch_id").parquet(self.path))


def read_windows(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(windows, late rows) that a :class:`WindowSink` wrote; ``schema``: of the stream of :func:`windows_and_late`."""
    plain = StructType([*[f for f in schema.fields if f.name != "kind"], StructField("kind", StringType()), StructField("_batch_id", LongType())])
    rows = spark.read.schema(plain).parquet(path)
    windows = rows.where("kind = 'window'").groupBy("key", "window_start", "window_end").agg(F.sum("n").alias("n"))
    return windows, rows.where("kind = 'late'").select("window_start", "window_end", "row.*")
