"""Deduplication. Copies of a key are reduced before the shuffle in every variant:
``row_number() = 1`` keeps one row per key and map task (a window group limit),
and the aggregates combine map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One whole row per key: the least by ``order_by``, then by all its columns.

    Null keys form a group of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = dict.fromkeys([*[c for c in order_by if c in rest], *rest])
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def collapse_quasi_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    *,
    max_cols: Sequence[str],
    first_cols: Sequence[str] = (),
    order_by: str = "timestamp",
) -> DataFrame:
    """One row per key: maxima of counters, earliest known value of other columns."""
    firsts = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(order_by).alias("at"), F.col(c).alias("v"))))[
            "v"
        ].alias(c)
        for c in first_cols
    ]
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in max_cols], *firsts)


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], ts: str = "timestamp", tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row with the least timestamp per key."""
    return first_per_key(df, keys, [ts, *tie_break])
