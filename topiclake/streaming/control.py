"""Start, wait for, stop and inspect streaming queries.

Every query gets an explicit name and its own checkpoint folder: two named
queries sharing a session-default checkpoint would resume each other's
progress, and an unnamed one would silently replay everything.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

from topiclake import session


def trigger_kwargs(trigger: str | None) -> dict:
    """``"5 seconds"`` → processing time; ``"availableNow"`` / ``"once"``; None = as fast as possible."""
    if trigger is None:
        return {}
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start(
    df: DataFrame,
    name: str,
    checkpoint: str,
    sink: str = "parquet",
    path: str | None = None,
    output_mode: str = "append",
    trigger: str | None = "5 seconds",
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    partition_by: Iterable[str] = (),
    options: dict | None = None,
) -> StreamingQuery:
    """Start one named query with its own checkpoint.

    ``sink``: ``parquet`` / ``json`` (append to ``path``), ``table`` (append to
    table ``path``), ``foreachBatch``, or the driver-side debugging sinks
    ``console`` / ``memory`` (these bring every row to the driver: small
    streams only).
    """
    w = df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if trigger is not None:
        w = w.trigger(**trigger_kwargs(trigger))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if sink == "foreachBatch":
        return w.foreachBatch(foreach_batch).start()
    if sink in ("console", "memory"):
        if sink == "console":
            w = w.option("truncate", "false")
        return w.format(sink).start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    if sink == "table":
        return w.toTable(path)
    return w.format(sink).start(path)


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` / ``once`` query, as long as it takes unless the caller sets a bound; raise its error if it failed."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()
    return query


def await_any(spark: SparkSession, timeout_s: float | None = None):
    """Wait until any active query ends (a failure in any of them is seen).

    Spark answers at once, or raises again, for queries that ended since the last
    ``spark.streams.resetTerminated()``: reset before starting queries to wait for.
    """
    return spark.streams.awaitAnyTermination(timeout_s) if timeout_s else spark.streams.awaitAnyTermination()


def run_all(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Wait for several queries at once; the first failure of any is raised when it happens."""
    queries = list(queries)
    while any(q.isActive for q in queries):
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
    for q in queries:
        run_to_end(q)


def stop_all(spark: SparkSession) -> list[str]:
    stopped = []
    for q in spark.streams.active:
        q.stop()
        stopped.append(q.name or str(q.id))
    return stopped


PROGRESS_SCHEMA = StructType(
    [
        StructField("name", StringType()),
        StructField("id", StringType()),
        StructField("run_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("num_input_rows", LongType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """Every progress event of a session's queries, kept as a table.

    A query itself holds only its last hundred or so events.  The log gets each one
    as it happens and writes them to ``path`` in parts of ``every``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, every: int = 1000):
        self.spark, self.every = spark, every
        self.path = path or session.fresh_path(spark, "tables", "progress")
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.news = threading.Condition()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.news:
            self.rows.append((p.name, str(p.id), str(p.runId), int(p.batchId), int(p.numInputRows)))
            if len(self.rows) >= self.every:
                self._write()

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def _write(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def frame(self, queries: Iterable[StreamingQuery] = (), timeout_s: float = 600) -> DataFrame:
        """All events so far; waits for the last event of ``queries`` that have ended, and raises if it doesn't come."""
        wanted = {str(q.runId) for q in queries if not q.isActive}
        with self.news:
            if not self.news.wait_for(lambda: wanted <= self.ended, timeout=timeout_s):
                raise TimeoutError(f"no end of {len(wanted - self.ended)} queries seen in {timeout_s}s: their events may be missing")
            self._write()
        if not session.path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path)

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def status(query: StreamingQuery) -> dict:
    return {"name": query.name, "id": str(query.id), "active": query.isActive, **query.status}


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """A fresh checkpoint folder for a query under the shared root."""
    return session.fresh_path(spark, "checkpoints", name)


def snapshot(spark: SparkSession, path: str, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Monitor a growing table: (row count, first ``n`` rows); empty frames while it does not exist yet."""
    if not session.path_exists(spark, path):
        empty = spark.createDataFrame([], "total_rows BIGINT")
        return empty, empty
    table = spark.read.parquet(path)
    return table.agg(F.count(F.lit(1)).alias("total_rows")), table.limit(n)
