"""As-of and interval joins on an epoch-millisecond column.

Every right column is matched by itself: a left row gets the closest non-null
value of that column, together with that value's own staleness limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import bucket_of
from tidemark.session import cut_lineage

# Fixed value: an hour plus twenty seconds, for sources that report hourly.
DEFAULT_LOOKBACK_MS = 3_620_000
#: Width of the buckets a key is split into, whatever the lookback: what is older is carried.
DEFAULT_BUCKET_MS = 3_600_000

_BUCKET, _PROBE = "__bucket", "__probe"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    lookback_ms: int | None = DEFAULT_LOOKBACK_MS,
    match: str = "previous",
    left_map: Mapping[str, str] | None = None,
    right_map: Mapping[str, str] | None = None,
    right_cols: Sequence[str] | None = None,
    strategy: str = "bucketed",
    bucket_ms: int | None = None,
    tie_break: Sequence[str] = (),
    null_safe_keys: bool = False,
    collapse_left: bool = False,
    skip_empty: bool = False,
) -> DataFrame:
    """Attach to each left row the closest right value of every column.

    ``match="previous"`` looks at right rows at or before the left row,
    ``match="next"`` at or after it. A value further away than ``lookback_ms``
    (inclusive) is null; ``None`` sets no limit. Left rows keep their number, but
    those without a timestamp are dropped. Null keys match nothing unless
    ``null_safe_keys``. Right rows that share keys and timestamp are decided by
    the greatest ``tie_break`` columns, then the greatest value.
    ``left_map``/``right_map`` select and rename columns (source to target, the
    timestamp is always kept). ``collapse_left`` keeps one row per keys and
    timestamp. ``skip_empty`` first counts the values of every right column, in one
    job, and leaves columns without any out of the join; they come out null.

    ``strategy="bucketed"`` splits every key into time buckets of ``bucket_ms``
    and carries only the last value of a bucket into later ones, so that no task
    holds more than the distinct timestamps of one bucket, however hot the key or
    the timestamp is. ``strategy="window"`` sorts each key's rows in one task: a
    shuffle less, for keys known to be even. ``strategy="scan"`` sorts all rows by keys and
    timestamp into parts of about equal size, whatever the keys are: each part is folded
    to one row per key, those rows are scanned, and what comes before a part is carried
    into it. It is for keys so hot that a single bucket is too much for a task.
    """
    keys = list(keys)
    left, right = _mapped(left, left_map, ts), _mapped(right, right_map, ts)
    values = list(right_cols or [c for c in right.columns if c not in (*keys, ts)])
    _check(left, right, keys, ts, values, tie_break, match, strategy)

    left = left.where(F.col(ts).isNotNull())
    if collapse_left:
        left = _one_per_timestamp(left, keys, ts)
    empty = {}
    if skip_empty:
        counts = non_null_counts(right, values).first()
        empty = {c: F.lit(None).cast(right.schema[c].dataType) for c in values if counts[c] == 0}
    names, values = values, [c for c in values if c not in empty]
    if not values:
        return left.select("*", *[empty[c].alias(c) for c in names])
    right = right.where(F.col(ts).isNotNull()).select(
        *keys, ts, *dict.fromkeys([*values, *tie_break])
    )
    if not null_safe_keys:
        right = right.where(_all_known(keys))
    args = (left, right, keys, ts, values, lookback_ms, match, tie_break, null_safe_keys)
    if strategy == "window":
        joined = _by_window(*args)
    elif strategy == "scan":
        joined = _by_scan(*args)
    else:
        joined = _by_bucket(*args, bucket_ms or DEFAULT_BUCKET_MS)
    return joined.withColumns(empty).select(*left.columns, *names) if empty else joined


def non_null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of known values of each column."""
    return df.agg(*[F.count(c).alias(c) for c in cols])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    right_ts: str = "right_ts",
    lookback_ms: int = DEFAULT_LOOKBACK_MS,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys whose right row lies 0..``lookback_ms`` before the left.

    An equi-join on keys and time bucket: right rows are copied to their own and
    the following bucket. ``right_ts`` names the matched timestamp in the result.
    """
    keys = list(keys)
    clash = (set(left.columns) & set(right.columns)) - {*keys, ts}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    width = max(1, lookback_ms)
    bucket = bucket_of(F.col(right_ts), width)
    right = right.withColumnRenamed(ts, right_ts).withColumn(
        _BUCKET, F.explode(F.array(bucket, bucket + 1))
    )
    left = left.withColumn(_BUCKET, bucket_of(F.col(ts), width))
    r = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        F.col(_BUCKET).alias("__r_bucket"),
        *[c for c in right.columns if c not in (*keys, _BUCKET)],
    )
    gap = F.col(ts) - F.col(right_ts)
    on = [F.col(k) == F.col(f"__r_{k}") for k in keys]
    on += [F.col(_BUCKET) == F.col("__r_bucket"), gap.between(0, lookback_ms)]
    return left.join(r, on, how).drop(_BUCKET, "__r_bucket", *[f"__r_{k}" for k in keys])


def _by_bucket(left, right, keys, ts, values, lookback_ms, match, tie_break, null_safe, width):
    probes = left.select(*keys, ts, F.lit(True).alias(_PROBE))
    if not null_safe:
        probes = probes.where(_all_known(keys))
    points = probes.unionByName(
        right.withColumn(_PROBE, F.lit(False)), allowMissingColumns=True
    ).withColumn(_BUCKET, bucket_of(F.col(ts), width))
    points = _one_per_time(points, [*keys, _BUCKET], ts, values, tie_break)
    return _carried(left, points, keys, ts, values, lookback_ms, match, null_safe)


def _by_scan(left, right, keys, ts, values, lookback_ms, match, tie_break, null_safe):
    probes = left.select(*keys, ts, F.lit(True).alias(_PROBE))
    if not null_safe:
        probes = probes.where(_all_known(keys))
    points = probes.unionByName(right.withColumn(_PROBE, F.lit(False)), allowMissingColumns=True)
    points = in_range_parts(_one_per_time(points, keys, ts, values, tie_break), [*keys, ts], _BUCKET)
    return _carried(left, points, keys, ts, values, lookback_ms, match, null_safe)


def in_range_parts(df: DataFrame, by: Sequence[str], part: str, parts: int | None = None) -> DataFrame:
    """``df`` stored with the number of a part: ranges of about equal size in the order of ``by``.

    Rows that are equal in ``by`` share a part. There are as many parts as shuffle partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *by).withColumn(part, F.spark_partition_id().cast("long")))


def _one_per_time(points, keys, ts, values, tie_break):
    """One row per keys and timestamp; copies are combined before the shuffle."""
    points = points.groupBy(*keys, ts).agg(
        F.max(_PROBE).alias(_PROBE), *[_pick(c, tie_break).alias(_v(c)) for c in values]
    )
    return points.select(
        "*", *[F.when(F.col(_v(c)).isNotNull(), F.col(ts)).alias(_t(c)) for c in values]
    )


def _carried(left, points, keys, ts, values, lookback_ms, match, null_safe):
    """The closest values of points in buckets, where later buckets have later times."""
    closest_ts, closest = (F.max, F.max_by) if match == "previous" else (F.min, F.min_by)
    edges = points.groupBy(*keys, _BUCKET).agg(
        F.max(_PROBE).alias(_PROBE),
        *[closest(_v(c), _t(c)).alias(_v(c)) for c in values],
        *[closest_ts(_t(c)).alias(_t(c)) for c in values],
    )
    earlier = Window.partitionBy(*keys).orderBy(_nearest_last(_BUCKET, match)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        edges.select(*keys, _BUCKET, _PROBE, *_last_of(values, earlier))
        .where(_PROBE)
        .withColumn(_PROBE, F.lit(False))
    )

    # A carried row has no timestamp of its own and sorts first in its bucket.
    upto = Window.partitionBy(*keys, _BUCKET).orderBy(_nearest_last(ts, match)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    matched = (
        points.unionByName(carried, allowMissingColumns=True)
        .select(*keys, ts, _PROBE, *_last_of(values, upto))
        .where(_PROBE)
        .select(
            *[F.col(k).alias(f"__r_{k}") for k in keys],
            F.col(ts).alias("__r_ts"),
            *_gated(values, ts, lookback_ms),
        )
    )
    equal = [
        F.col(k).eqNullSafe(F.col(f"__r_{k}")) if null_safe else F.col(k) == F.col(f"__r_{k}")
        for k in keys
    ]
    joined = left.join(matched, [*equal, F.col(ts) == F.col("__r_ts")], "left")
    return joined.select(*left.columns, *values)


def _by_window(left, right, keys, ts, values, lookback_ms, match, tie_break, null_safe):
    rest = [c for c in left.columns if c not in (*keys, ts)]
    right = right.groupBy(*keys, ts).agg(*[_pick(c, tie_break).alias(_v(c)) for c in values])
    right = right.select(
        *keys, ts, F.lit(False).alias(_PROBE), *[_v(c) for c in values],
        *[F.when(F.col(_v(c)).isNotNull(), F.col(ts)).alias(_t(c)) for c in values],
    )
    packed = F.struct(*rest) if rest else F.struct(F.lit(1).alias("__none"))
    known = _all_known(keys)
    probes = left if null_safe else left.where(known)
    probes = probes.select(*keys, ts, F.lit(True).alias(_PROBE), packed.alias("__left"))

    # Rows at one timestamp: right before left, so that equal timestamps match.
    upto = (
        Window.partitionBy(*keys)
        .orderBy(_nearest_last(ts, match), F.col(_PROBE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = (
        probes.unionByName(right, allowMissingColumns=True)
        .select(*keys, ts, _PROBE, "__left", *_last_of(values, upto))
        .where(_PROBE)
        .select(*keys, ts, *[F.col("__left")[c].alias(c) for c in rest], *_gated(values, ts, lookback_ms))
        .select(*left.columns, *values)
    )
    if null_safe:
        return joined
    return joined.unionByName(left.where(~known), allowMissingColumns=True)


def _mapped(df: DataFrame, names: Mapping[str, str] | None, ts: str) -> DataFrame:
    if ts not in df.columns:
        raise ValueError(f"no timestamp column {ts!r}")
    if not names:
        return df
    return df.select(*[F.col(s).alias(t) for s, t in names.items() if s != ts], ts)


def _check(left, right, keys, ts, values, tie_break, match, strategy):
    if match not in ("previous", "next"):
        raise ValueError("match must be 'previous' or 'next'")
    if strategy not in ("bucketed", "window", "scan"):
        raise ValueError("strategy must be 'bucketed', 'window' or 'scan'")
    for side, df, wanted in (
        ("left", left, keys),
        ("right", right, [*keys, *values, *tie_break]),
    ):
        missing = sorted(set(wanted) - set(df.columns))
        if missing:
            raise ValueError(f"{side} side has no columns {missing}")
    clash = sorted(set(values) & set(left.columns))
    if clash:
        raise ValueError(f"columns on both sides: {clash}; rename them with right_map")


def _all_known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _one_per_timestamp(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, ts)]
    if not rest:
        return df.select(*keys, ts).distinct()
    one = df.groupBy(*keys, ts).agg(F.min(F.struct(*rest)).alias("__one"))
    return one.select(*keys, ts, "__one.*").select(*df.columns)


def _pick(c: str, tie_break: Sequence[str]) -> Column:
    if not tie_break:
        return F.max(c)
    ranked = F.struct(*[F.col(t).alias(f"k{n}") for n, t in enumerate(tie_break)], F.col(c).alias("v"))
    return F.max(F.when(F.col(c).isNotNull(), ranked))["v"]


def _nearest_last(c: str, match: str) -> Column:
    return F.asc_nulls_first(c) if match == "previous" else F.desc_nulls_first(c)


def _last_of(values: list[str], window) -> list[Column]:
    return [
        F.last(name, ignorenulls=True).over(window).alias(name)
        for c in values
        for name in (_v(c), _t(c))
    ]


def _gated(values: list[str], ts: str, lookback_ms: int | None) -> list[Column]:
    if lookback_ms is None:
        return [F.col(_v(c)).alias(c) for c in values]
    return [
        F.when(F.abs(F.col(ts) - F.col(_t(c))) <= lookback_ms, F.col(_v(c))).alias(c)
        for c in values
    ]


def _v(c: str) -> str:
    return f"__v_{c}"


def _t(c: str) -> str:
    return f"__t_{c}"
