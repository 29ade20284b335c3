"""Session windows that do not put one hot key into one task.

``session_window`` groups by the key and sorts each key's events in one
task; a key with a third of all events would be sorted by one task.  Here:

1. only (key, time) are kept, so every shuffle below is narrow;
2. rows are range-partitioned on (key, time, source position) into slices
   and sorted; a hot key is cut across slices;
3. inside each (slice, key) ``lag`` gives the previous event; for the first
   row of a slice the previous event is the last row of the previous
   non-empty slice when it has the same key — a table with one row per slice;
4. a row opens a session when it has no previous event or the gap is at
   least ``gap``; the session number is the running count of openings inside
   (slice, key) plus the openings of the same key in earlier slices.  Only the
   first and last key of a slice can span slices, so that base table has at
   most two rows per slice;
5. sessions are aggregated per (key, session number): count, first, last.

A session is [first event, last event + gap), as ``session_window`` gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topiclake import session
from topiclake.operators.offsets import MAX_CUTS, TIE, leaf_size, with_tie

_POS, _SLICE = "_tl_pos", "_tl_slice"
_ROW_BITS = 33


def session_spans(
    df: DataFrame,
    by: str,
    time: str,
    gap_seconds: int,
    slices: int | None = None,
) -> DataFrame:
    """(``by``, ``session_start``, ``session_end``, ``n``) of every session, skew-proof."""
    gap = int(gap_seconds) * 1_000_000
    narrow = df.select(F.col(by).alias("_by"), F.unix_micros(F.col(time).cast("timestamp")).alias("_t"))
    narrow = narrow.where(F.col("_t").isNotNull())  # as session_window: no time, no session
    if slices is None:
        total = narrow.count()
        slices = min(MAX_CUTS, -(-total // leaf_size(df, total))) or 1
    keyed = with_tie(narrow)
    order = ["_by", "_t", TIE]
    ranged = (keyed.repartitionByRange(slices, *order).sortWithinPartitions(*order)
              .withColumn(_POS, F.monotonically_increasing_id())
              .withColumn(_SLICE, F.shiftright(F.col(_POS), _ROW_BITS)))
    # The range bounds are sampled, so every branch below has to read one evaluation: the
    # narrow rows are cut in the shared checkpoint folder, which goes with the frame.
    session.shared_root(df.sparkSession)
    ranged = ranged.checkpoint()

    # First key and last (key, time) of every non-empty slice; previous slice's last row.
    ends = ranged.groupBy(_SLICE).agg(
        F.min_by("_by", _POS).alias("first_by"),
        F.max_by(F.struct("_by", "_t"), _POS).alias("last"),
    )
    ends = ends.withColumn("prev_last", F.lag("last").over(Window.orderBy(_SLICE)))
    ends = ends.select(
        _SLICE, "first_by", F.col("last._by").alias("last_by"),
        F.when(F.col("prev_last._by").eqNullSafe(F.col("first_by")), F.col("prev_last._t")).alias("carry_t"),
    )
    ends = F.broadcast(ends)  # a row per slice, MAX_CUTS at most

    within = Window.partitionBy(_SLICE, "_by").orderBy("_t", TIE)
    rows = ranged.withColumn("_prev", F.lag("_t").over(within)).join(ends, _SLICE)
    prev = F.when(F.col("_prev").isNull() & F.col("_by").eqNullSafe(F.col("first_by")), F.col("carry_t")) \
        .otherwise(F.col("_prev"))
    rows = rows.withColumn("_new", F.when(prev.isNull() | ((F.col("_t") - prev) >= gap), 1).otherwise(0))
    rows = rows.withColumn("_local", F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0)))

    # Openings of boundary keys per slice (≤ 2 rows per slice), summed over earlier slices.
    edge = rows.where(F.col("_by").eqNullSafe(F.col("first_by")) | F.col("_by").eqNullSafe(F.col("last_by")))
    bt = edge.groupBy(_SLICE, "_by").agg(F.sum("_new").alias("_f"))
    earlier = Window.partitionBy("_by").orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.select(F.col(_SLICE).alias("_bs"), F.col("_by").alias("_bb"),
                   F.coalesce(F.sum("_f").over(earlier), F.lit(0)).alias("_base"))
    bt = F.broadcast(bt)  # two rows per slice at most

    cond = (F.col(_SLICE) == F.col("_bs")) & F.col("_by").eqNullSafe(F.col("_bb"))
    out = rows.join(bt, cond, "left").drop("_bs", "_bb")
    out = out.withColumn("_session", F.coalesce(F.col("_base"), F.lit(0)) + F.col("_local"))
    spans = out.groupBy("_by", "_session").agg(
        F.count(F.lit(1)).alias("n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    return spans.select(
        F.col("_by").alias(by),
        F.timestamp_micros("_first").alias("session_start"),
        F.timestamp_micros(F.col("_last") + gap).alias("session_end"),
        "n",
    )
