"""Mergeable time bins and the trailing window over them.

A bin row is a partial aggregate: several rows may exist for one bin, one per
run that saw some of its flows, and the window sums over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import interval_literal, time_bin

BIN_KEYS = ("timeBin", "mac", "appName", "side", "uuid", "label")
WINDOW_KEYS = ("mac", "appName", "side", "label", "uuid")
DEVICE_KEYS = ("mac", "label", "windowStart", "windowEnd", "uuid")


def time_bins(flows: DataFrame, interval: timedelta, label: str = "logicalClass") -> DataFrame:
    """Partial sums per bin, device, ``side-app`` and class.

    ``lastTimestamp`` keeps the latest flow of each row, so that the end of the
    data is known from the bins alone.
    """
    keyed = flows.select(
        time_bin("timestamp", interval).alias("timeBin"),
        "mac",
        F.concat("side", F.lit("-"), "appName").alias("appName"),
        "side",
        "uuid",
        F.col(label).alias("label"),
        "clientBytesSent",
        "serverBytesSent",
        "timestamp",
    )
    bins = keyed.groupBy(*BIN_KEYS).agg(
        _sum("clientBytesSent").alias("clientBytesInterval"),
        _sum("serverBytesSent").alias("serverBytesInterval"),
        F.count(F.lit(1)).alias("numFlowsInterval"),
        F.max("timestamp").alias("lastTimestamp"),
    )
    total = F.col("clientBytesInterval") + F.col("serverBytesInterval")
    return bins.withColumn("totalBytesInterval", total)


def last_record(bins: DataFrame) -> Column:
    """Latest flow among ``bins``, as a scalar subquery."""
    return bins.agg(F.max("lastTimestamp")).scalar()


def recent_bins(
    bins: DataFrame, end: Column, window: timedelta, fresh: Column | None = None
) -> DataFrame:
    """State that can still fall into a window ending at ``end``, and all ``fresh`` rows."""
    recent = F.col("timeBin") > end - interval_literal(window)
    return bins.where(recent if fresh is None else fresh | recent)


def complete_bins(bins: DataFrame, interval: timedelta, last: Column) -> DataFrame:
    """Bins whose end does not lie after the last record."""
    return bins.where(F.col("timeBin") + interval_literal(interval) <= last)


def trailing_window(
    bins: DataFrame, interval: timedelta, window: timedelta, last: Column
) -> DataFrame:
    """Sums per device and app over the newest window of complete bins.

    The window ends with the latest complete bin, is at most ``window`` long and
    starts no earlier than the first complete bin. Without a complete bin the
    result is empty. ``bins`` should be a stored table: it is read for the bounds
    and again for the sums.
    """
    done = complete_bins(bins, interval, last)
    bounds = done.agg(
        F.struct(
            F.greatest(
                F.max("timeBin") + interval_literal(interval) - interval_literal(window),
                F.min("timeBin"),
            ).alias("start"),
            (F.max("timeBin") + interval_literal(interval)).alias("end"),
        )
    ).scalar()
    inside = done.where(F.col("timeBin") >= bounds["start"])
    sums = inside.groupBy(*WINDOW_KEYS).agg(
        _sum("clientBytesInterval").alias("clientBytesWindow"),
        _sum("serverBytesInterval").alias("serverBytesWindow"),
        _sum("totalBytesInterval").alias("totalBytesWindow"),
        _sum("numFlowsInterval").alias("numFlowsWindow"),
    )
    return sums.withColumns({"windowStart": bounds["start"], "windowEnd": bounds["end"]})


def nested_usage(windowed: DataFrame, keys: Sequence[str] = DEVICE_KEYS) -> DataFrame:
    """One row per device with its apps as a list sorted by name."""
    return windowed.groupBy(*keys).agg(F.sort_array(F.collect_list(nested_app())).alias("apps"))


def nested_app() -> Column:
    """The window measures of one app as a struct."""
    return F.struct(
        "appName",
        F.col("clientBytesWindow").alias("totalClientBytes"),
        F.col("serverBytesWindow").alias("totalServerBytes"),
        F.col("totalBytesWindow").alias("totalBytes"),
        F.col("numFlowsWindow").alias("numFlows"),
    )


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))
