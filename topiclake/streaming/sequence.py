"""Event sequence on a stream: each payment's events are numbered as they come, without reading what came before.

Beside the numbered rows stands a table of last numbers: one row per payment and micro-batch that touched it, (payment, last number, last
time and id).  A micro-batch looks its payments up there, numbers its own rows after them, and writes both under its batch id, so a replay
overwrites itself.  Every ``EVERY`` batches the last numbers are merged into one total, so a lookup reads one total and fewer than ``EVERY``
batches.  An event that is earlier than one already numbered is marked, and only the payments that have such events
are numbered again when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from topiclake import session
from topiclake.operators.offsets import assign_offsets

EVERY = 50
_LAST = "payment_id STRING, last_seq BIGINT, last STRUCT<t: TIMESTAMP, id: STRING>"


class SequenceWriter:
    """``foreachBatch``: rows with payment_id, event_id and ``time`` (a timestamp) → numbered rows under ``path``."""

    def __init__(self, path: str, run: str, time: str = "event_time", every: int = EVERY):
        self.path, self.run, self.time, self.every = path.rstrip("/"), run, time, every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = f"{self.path}/run.txt"
        if not session.write_text(spark, owner, self.run, overwrite=False) and session.read_text(spark, owner) != self.run:
            raise RuntimeError(f"{self.path} is numbered by another query: a fresh checkpoint needs a fresh table")
        staged = f"{self.path}/staged/{batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(batch.schema).parquet(staged)
        place = F.struct(F.col(self.time).alias("t"), F.col("event_id").alias("id"))
        touched = rows.select(F.col("payment_id").alias("_payment")).distinct()
        before = self.last_numbers(spark, batch_id).join(touched, F.col("payment_id").eqNullSafe(F.col("_payment")), "left_semi")
        numbered = assign_offsets(rows, groups=("payment_id",), order=(self.time, "event_id"), column="_pos", many_groups=True)
        numbered = numbered.join(before.withColumnRenamed("payment_id", "_payment"), F.col("payment_id").eqNullSafe(F.col("_payment")), "left")
        numbered = numbered.select(*batch.columns, (F.coalesce("last_seq", F.lit(0)) + F.col("_pos") + 1).alias("seq"),
                                   F.coalesce(place < F.col("last"), F.lit(False)).alias("out_of_order"), F.lit(batch_id).cast("long").alias("_batch_id"))
        self._write(numbered, "rows")
        done = spark.read.schema(_stored(batch.schema)).parquet(f"{self.path}/rows").where(F.col("_batch_id") == batch_id)
        new = done.groupBy("payment_id").agg(F.max("seq").alias("last_seq"), F.max(place).alias("last"))
        self._write(_merged(new.unionByName(before)).withColumn("_batch_id", F.lit(batch_id).cast("long")), "last")
        if batch_id % self.every == self.every - 1:
            total = self.last_numbers(spark, batch_id + 1, totals_before=batch_id)
            self._write(total.withColumn("_batch_id", F.lit(batch_id).cast("long")), "totals")
        session.delete(spark, staged)

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id").parquet(f"{self.path}/{name}")

    def last_numbers(self, spark: SparkSession, batch_id: int, totals_before: int | None = None) -> DataFrame:
        """Last number of each payment before a batch: the newest total before it and the batches since."""
        total = (batch_id if totals_before is None else totals_before) // self.every * self.every - 1
        while total >= 0 and not session.path_exists(spark, f"{self.path}/totals/_batch_id={total}"):
            total -= self.every  # no row came in that batch
        parts = [spark.createDataFrame([], _LAST)]
        if total >= 0:
            parts.append(spark.read.schema(_LAST).parquet(f"{self.path}/totals/_batch_id={total}"))
        paths = [p for p in (f"{self.path}/last/_batch_id={b}" for b in range(max(total + 1, 0), batch_id)) if session.path_exists(spark, p)]
        if paths:
            parts.append(spark.read.schema(_LAST).parquet(*paths))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return _merged(out)


def _merged(last: DataFrame) -> DataFrame:
    return last.groupBy("payment_id").agg(F.max("last_seq").alias("last_seq"), F.max("last").alias("last"))


def _stored(schema: StructType) -> StructType:
    own = [StructField("seq", LongType()), StructField("out_of_order", BooleanType()), StructField("_batch_id", LongType())]
    return StructType([*schema.fields, *own])


def read_sequence(spark: SparkSession, path: str, schema: StructType, time: str = "event_time") -> DataFrame:
    """The numbered rows; payments with events out of order are numbered again over all their rows."""
    rows = spark.read.schema(_stored(schema)).parquet(f"{path.rstrip('/')}/rows").drop("_batch_id")
    moved = rows.where("out_of_order").select(F.col("payment_id").alias("_payment")).distinct()
    same = F.col("payment_id").eqNullSafe(F.col("_payment"))
    again = assign_offsets(rows.join(moved, same, "left_semi").drop("seq"), groups=("payment_id",), order=(time, "event_id"), column="seq", many_groups=True)
    again = again.withColumn("seq", F.col("seq") + 1)
    return rows.join(moved, same, "left_anti").unionByName(again)
