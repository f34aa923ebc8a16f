"""Epoch-millisecond helpers and epoch-aligned time bins."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_ms(ts: Column | str) -> Column:
    """Timestamp (with or without zone) to epoch milliseconds."""
    return F.unix_millis(_column(ts).cast("timestamp"))


def bucket_of(ts_ms: Column, width_ms: int) -> Column:
    """Number of the tumbling bucket of ``width_ms`` that holds ``ts_ms``."""
    return F.floor(ts_ms / F.lit(width_ms))


def time_bin(ts: Column | str, interval: timedelta) -> Column:
    """Start of the epoch-aligned bin of length ``interval``."""
    micros = F.unix_micros(_column(ts).cast("timestamp"))
    width = F.lit(_micros(interval))
    return F.timestamp_micros(micros - F.pmod(micros, width))


def interval_literal(interval: timedelta) -> Column:
    """``interval`` as a day-time interval literal."""
    return F.lit(interval)


def start_time(
    watermark: datetime, end: datetime, interval: timedelta, max_intervals: int = 4
) -> datetime:
    """Start of a run: at least one interval back, at most ``max_intervals``."""
    return min(end - interval, max(watermark, end - max_intervals * interval))


def _micros(interval: timedelta) -> int:
    return interval // timedelta(microseconds=1)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
