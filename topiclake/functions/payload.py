"""Scalar helpers for payload fields: event-time text, exact money, picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topiclake.schemas import EVENT_TIME_FORMAT

MONEY = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time_text(ts: Column | str) -> Column:
    """Millisecond time text ``yyyy-MM-dd HH:mm:ss.SSS``."""
    return F.date_format(_c(ts).cast("timestamp"), EVENT_TIME_FORMAT)


def parse_event_time(text: Column | str) -> Column:
    """Inverse of :func:`event_time_text`; NULL (not an error, even under ANSI) for malformed text."""
    return F.try_to_timestamp(_c(text), F.lit(EVENT_TIME_FORMAT))


def net_of(amount: Column | str, rate: str = "0.9") -> Column:
    """``round(amount * rate, 2)`` computed in decimals, returned as DOUBLE."""
    prod = _c(amount).cast(MONEY) * F.lit(rate).cast("decimal(2,1)")
    return F.round(prod, 2).cast("double")


def money_sum(amount: Column | str) -> Column:
    """Exact 2-decimal sum of a DOUBLE money column, returned as DOUBLE."""
    return F.sum(_c(amount).cast(MONEY)).cast("double")


def pick(index: Column, choices: Sequence[str]) -> Column:
    """``choices[index % len(choices)]`` for a non-negative integer index."""
    out = None
    n = len(choices)
    for i, value in enumerate(choices[:-1]):
        cond = (index % n) == i
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(choices[-1]) if out is not None else F.lit(choices[-1])


def last_digits(number: Column, width: int = 4) -> Column:
    """Last ``width`` digits of a non-negative integer as zero-padded text."""
    return F.lpad((number % (10 ** width)).cast("string"), width, "0")
