"""As-of join: each row of one side with the latest row of the other side at or before its time, per key.

Both sides become one narrow stream of rows ordered by (key, time, side), in which a running "last value that is not
null" is the answer.  ``method="window"`` runs it per key.  The default cuts a hot key: the rows are range-partitioned
into slices, each slice runs on its own, and the value that a key carries over a slice boundary comes
from a table with one row per slice, made by the same running last value over slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclake import session
from topiclake.operators.offsets import MAX_CUTS, SMALL_BYTES, leaf_size

_KEY, _AT, _SIDE, _VALUE, _ROW, _SLICE = "_tl_key", "_tl_at", "_tl_side", "_tl_value", "_tl_row", "_tl_slice"


def as_of(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, values: Sequence[str],
          method: str = "split", slices: int | None = None) -> DataFrame:
    """All rows of ``left`` with ``values`` of the last ``right`` row of the same ``on`` at or before ``left_time``.

    Null where there is none, and for a null key or time.  Of several right rows at one time
    the one with the greatest values (compared in their order) counts.
    """
    if method not in ("split", "window"):
        raise ValueError(f"method must be 'split' or 'window', not {method!r}")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    found = F.struct(*[F.col(c) for c in values])
    r = right.where(F.col(on).isNotNull() & F.col(right_time).isNotNull())
    r = r.groupBy(F.col(on).alias(_KEY), micros(right_time).alias(_AT)).agg(F.max(found).alias(_VALUE)).withColumn(_SIDE, F.lit(0))
    at = F.when(F.col(on).isNotNull(), micros(left_time))
    rows = left.select(F.col(on).alias(_KEY), at.alias(_AT), F.lit(1).alias(_SIDE), F.struct(*[F.col(c) for c in left.columns]).alias(_ROW))
    both = rows.unionByName(r, allowMissingColumns=True)
    if method == "split" and slices is None and session.estimated_bytes(both) <= SMALL_BYTES:
        method = "window"
    if method == "window":
        so_far = Window.partitionBy(_KEY).orderBy(_AT, _SIDE).rowsBetween(Window.unboundedPreceding, 0)
        out = both.withColumn(_VALUE, F.last(_VALUE, ignorenulls=True).over(so_far))
    else:
        out = _sliced(both, slices)
    return out.where(f"{_SIDE} = 1").select(f"{_ROW}.*", *[F.col(f"{_VALUE}.{c}").alias(c) for c in values])


def _sliced(both: DataFrame, slices: int | None) -> DataFrame:
    # Written once before the rows are counted, sampled and dealt: else each of the three would group the right side again.
    spark = both.sparkSession
    kept = session.fresh_path(spark, "staged", "asof_rows")
    both.write.option("compression", "zstd").parquet(kept)
    both = spark.read.schema(both.schema).parquet(kept)
    # Written once: the range bounds are sampled, so slices and carried values have to come from one evaluation.
    path = session.fresh_path(spark, "staged", "asof")
    if slices is None:
        total = both.count()
        slices = min(MAX_CUTS, -(-total // leaf_size(both, total))) or 1
    ranged = both.repartitionByRange(slices, _KEY, _AT, _SIDE).withColumn(_SLICE, F.spark_partition_id())
    ranged.write.option("compression", "zstd").parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    so_far = Window.partitionBy(_SLICE, _KEY).orderBy(_AT, _SIDE).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn(_VALUE, F.last(_VALUE, ignorenulls=True).over(so_far))

    # Per slice its first and last key, and the last value of the last key; carried on while the key goes on.
    ends = ranged.groupBy(_SLICE).agg(F.min(_KEY).alias("first_key"), F.max(_KEY).alias("last_key"))
    last = ranged.where(f"{_SIDE} = 0").groupBy(_SLICE, _KEY).agg(F.max_by(_VALUE, _AT).alias("last_value"))
    ends = ends.join(last, (ends[_SLICE] == last[_SLICE]) & (ends["last_key"] == last[_KEY]), "left").select(ends[_SLICE], "first_key", "last_key", "last_value")
    ends = ends.withColumn("held", F.last("last_value", ignorenulls=True).over(Window.partitionBy("last_key").orderBy(_SLICE)))
    over = Window.orderBy(_SLICE)  # a row per slice, MAX_CUTS at most
    ends = ends.select(_SLICE, "first_key", F.when(F.lag("last_key").over(over) == F.col("first_key"), F.lag("held").over(over)).alias("carried"))
    out = local.join(F.broadcast(ends), _SLICE)
    carried = F.when(F.col(_KEY) == F.col("first_key"), F.col("carried"))
    return out.withColumn(_VALUE, F.when(F.col(_AT).isNotNull(), F.coalesce(_VALUE, carried)))
