"""Extensions named as next steps: event-time windows, watermarks, linked-topic joins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclake.operators.sessions import session_spans

WINDOW_TEXT = "yyyy-MM-dd HH:mm:ss"


def event_times(events: DataFrame, ts: str = "ts") -> DataFrame:
    """``event_time`` as TIMESTAMP (watermarks refuse TIMESTAMP_NTZ), session time zone UTC."""
    return events.withColumn("event_time", F.col(ts).cast("timestamp"))


def _window_cols(w: str = "window") -> list:
    return [
        F.date_format(F.col(f"{w}.start"), WINDOW_TEXT).alias("window_start"),
        F.date_format(F.col(f"{w}.end"), WINDOW_TEXT).alias("window_end"),
    ]


def tumbling_counts(events: DataFrame, size: str, by: str = "event_type") -> DataFrame:
    g = events.groupBy(F.window("event_time", size), by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(*_window_cols(), by, "n")


def sliding_counts(events: DataFrame, size: str, slide: str, by: str = "event_type", method: str = "panes") -> DataFrame:
    """Counts of overlapping windows.

    ``method="panes"``: rows are counted once, per pane (the greatest common divisor of size and slide), and
    each pane's count is then added to the size / slide windows that hold it, so what is copied is one row per pane and
    ``by``, not every event.  ``method="window"`` is ``window(time, size, slide)``, which copies every event.
    """
    if method == "window":
        g = events.groupBy(F.window("event_time", size, slide), by).agg(F.count(F.lit(1)).alias("n"))
        return g.select(*_window_cols(), by, "n")
    long, step = _seconds(size), _seconds(slide)
    if step > long:
        raise ValueError(f"windows of {size} cannot start every {slide}: the slide is longer")
    pane = math.gcd(long, step)
    panes = events.groupBy(F.window("event_time", f"{pane} seconds").alias("pane"), by).agg(F.count(F.lit(1)).alias("n"))
    at = F.unix_timestamp("pane.start")
    last, least = at - F.pmod(at, F.lit(step)), at - long + pane  # windows that start from least to last hold the pane
    each = panes.select(by, "n", F.explode(F.sequence(last, least, F.lit(-step).cast("long"))).alias("start"))
    g = each.groupBy("start", by).agg(F.sum("n").alias("n"))
    return g.select(F.date_format(F.timestamp_seconds("start"), WINDOW_TEXT).alias("window_start"),
                    F.date_format(F.timestamp_seconds(F.col("start") + long), WINDOW_TEXT).alias("window_end"), by, "n")


def session_counts(events: DataFrame, gap: str, by: str = "user_id", method: str = "split",
                   slices: int | None = None) -> DataFrame:
    """Sessions of each ``by``: a new session after ``gap`` without events.

    ``method="window"`` is ``session_window`` (one task per key; also the form
    for streams); ``"split"`` cuts a hot key across tasks (operators.sessions).
    """
    if method == "window":
        g = events.groupBy(F.session_window("event_time", gap), by).agg(F.count(F.lit(1)).alias("n"))
        return g.select(*_window_cols("session_window"), by, "n")
    spans = session_spans(events, by, "event_time", _seconds(gap), slices=slices)
    return spans.select(
        F.date_format("session_start", WINDOW_TEXT).alias("window_start"),
        F.date_format("session_end", WINDOW_TEXT).alias("window_end"),
        by, "n",
    )


_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400}


def _seconds(text: str) -> int:
    """``"30 minutes"`` → 1800."""
    value, unit = text.split()
    return int(value) * _UNITS[unit.lower()]


def watermarked_counts(events: DataFrame, size: str, delay: str, by: str = "event_type") -> DataFrame:
    """Tumbling counts that tolerate ``delay`` of lateness; in append mode a window is emitted once closed."""
    g = (events.withWatermark("event_time", delay)
         .groupBy(F.window("event_time", size), by).agg(F.count(F.lit(1)).alias("n")))
    return g.select(*_window_cols(), by, "n")


def order_gps(orders: DataFrame, gps: DataFrame) -> DataFrame:
    """Each order with its GPS points (``order_id`` = ``order_key``).

    Both sides shuffle on the key; an order with very many points is split over
    several tasks at run time (adaptive skew join), whichever order it is.
    """
    o = orders.select("order_key", "amount", "status")
    g = gps.select(F.col("order_id").alias("order_key"), "lat", "lon", "speed_kph")
    return o.join(g, "order_key", "inner")


def payment_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Each order's payment with its events, aggregated per payment *before* the join.

    The pre-aggregation (partial + final) collapses a payment with very many
    events map-side, so the join sees one row per payment.
    """
    # min / max over the TIMESTAMP (fixed width: hash aggregate), formatted afterwards.
    per_payment = events.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )
    fmt = "yyyy-MM-dd HH:mm:ss.SSS"
    joined = orders.select("payment_id", "status").join(per_payment, "payment_id", "inner")
    return joined.select("payment_id", "status", "n_events", F.date_format("first_event", fmt).alias("first_event"),
                         F.date_format("last_event", fmt).alias("last_event"))
