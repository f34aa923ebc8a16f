"""As-of and interval joins of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join, interval_join
from tidemark.queries.inputs import DAY_MS, events_ms

_LOOKBACK = 3 * DAY_MS
_BUCKET = 3_600_000


def _purchases(spark, sf_dir):
    return events_ms(spark, sf_dir).where("event_type = 'purchase'").select(
        "event_id", "user_id", "ts", F.col("value").alias("amount")
    )


def _signals(spark, sf_dir):
    """Views and clicks, one column each."""
    kind, value = F.col("event_type"), F.col("value")
    return events_ms(spark, sf_dir).where(kind.isin("view", "click")).select(
        "user_id", "ts",
        F.when(kind == "view", value).alias("last_view"),
        F.when(kind == "click", value).alias("last_click"),
    )


def _asof(**options):
    def query(spark, sf_dir):
        args = {"lookback_ms": _LOOKBACK, **options}
        return asof_join(_purchases(spark, sf_dir), _signals(spark, sf_dir), ["user_id"], **args)

    return query


def _squeezed(df):
    """Nine tenths of the events belong to one user and lie within one hour."""
    hot = F.col("event_id") % 10 < 9
    return df.withColumns({
        "user_id": F.when(hot, 0).otherwise(F.col("user_id")).cast("long"),
        "ts": F.when(hot, F.col("ts") % _BUCKET).otherwise(F.col("ts")),
    })


def asof_scan(spark, sf_dir):
    """One hot user and hour, in parts of equal size: the views and clicks of the second before."""
    events = _squeezed(events_ms(spark, sf_dir))
    kind, value = F.col("event_type"), F.col("value")
    left = events.where(kind == "purchase").select("event_id", "user_id", "ts", value.alias("amount"))
    right = events.where(kind.isin("view", "click")).select(
        "user_id", "ts",
        F.when(kind == "view", value).alias("last_view"),
        F.when(kind == "click", value).alias("last_click"),
    )
    return asof_join(left, right, ["user_id"], lookback_ms=1000, strategy="scan")


def asof_renamed(spark, sf_dir):
    """Rename maps, a column subset and a timestamp column of another name."""
    left = _purchases(spark, sf_dir).withColumnRenamed("ts", "at")
    right = _signals(spark, sf_dir).withColumnRenamed("ts", "at")
    return asof_join(
        left, right, ["user"], ts="at", lookback_ms=_LOOKBACK, right_cols=["seen"],
        left_map={"user_id": "user", "event_id": "purchase"},
        right_map={"user_id": "user", "last_view": "seen", "last_click": "clicked"},
    )


def asof_two_keys(spark, sf_dir):
    """Two keys: the last event of the same type and user as an error's twin."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = events_ms(spark, sf_dir).withColumn("half", (k < 50))
    left = events.where("event_type = 'error'").select("event_id", "user_id", "half", "ts")
    right = events.where("event_type <> 'error'").select(
        "user_id", "half", "ts", F.col("event_type").alias("before"), F.col("value").alias("amount")
    )
    return asof_join(left, right, ["user_id", "half"], lookback_ms=_LOOKBACK, tie_break=["amount"])


def asof_skip_empty(spark, sf_dir):
    """A right column without any value is left out of the join."""
    signals = _signals(spark, sf_dir).withColumn("last_call", F.lit(None).cast("double"))
    return asof_join(
        _purchases(spark, sf_dir), signals, ["user_id"], lookback_ms=_LOOKBACK, skip_empty=True
    )


def asof_one_per_timestamp(spark, sf_dir):
    """Per user and day: one row, with the last values up to that day."""
    day = (F.col("ts") / DAY_MS).cast("long") * DAY_MS
    left = events_ms(spark, sf_dir).select("user_id", day.alias("ts"))
    return asof_join(
        left, _signals(spark, sf_dir), ["user_id"], lookback_ms=_LOOKBACK,
        bucket_ms=_BUCKET, collapse_left=True,
    )


def range_join_pairs(spark, sf_dir):
    """Errors in the hour before each purchase of the same user."""
    errors = events_ms(spark, sf_dir).where("event_type = 'error'").select(
        "user_id", "ts", F.col("event_id").alias("error_id")
    )
    return interval_join(
        _purchases(spark, sf_dir), errors, ["user_id"], right_ts="error_ts", lookback_ms=_BUCKET
    ).select("event_id", "error_id", "user_id", "ts", "error_ts")


QUERIES = {
    "asof_prev_per_column": _asof(),
    "asof_prev_single": _asof(right_cols=["last_view"]),
    "asof_next": _asof(match="next"),
    "asof_bucketed": _asof(bucket_ms=_BUCKET),
    "asof_window": _asof(strategy="window"),
    "asof_unbounded": _asof(lookback_ms=None, bucket_ms=DAY_MS),
    "asof_scan": asof_scan,
    "asof_renamed": asof_renamed,
    "asof_two_keys": asof_two_keys,
    "asof_skip_empty": asof_skip_empty,
    "asof_one_per_timestamp": asof_one_per_timestamp,
    "range_join_pairs": range_join_pairs,
}

# Right rows at one millisecond count as one; every left row at or after sees them.
_TAGGED = """
WITH e AS (SELECT *, (epoch_us(ts) // 1000) AS ms FROM events),
r AS (
  SELECT user_id, ms, max(value) FILTER (WHERE event_type = 'view') AS v,
    max(value) FILTER (WHERE event_type = 'click') AS c
  FROM e WHERE event_type IN ('view', 'click') GROUP BY ALL
),
tagged AS (
  SELECT event_id, user_id, ms, value AS amount, NULL::DOUBLE AS v, NULL::DOUBLE AS c
  FROM e WHERE event_type = 'purchase'
  UNION ALL SELECT NULL, user_id, ms, NULL, v, c FROM r
)"""


def _asof_sql(function: str, frame: str, columns: str) -> str:
    return f"""{_TAGGED},
filled AS (
  SELECT event_id, user_id, ms AS ts, amount,
    {function}(v IGNORE NULLS) OVER w AS last_view, {function}(c IGNORE NULLS) OVER w AS last_click
  FROM tagged WINDOW w AS (PARTITION BY user_id ORDER BY ms RANGE BETWEEN {frame})
)
SELECT {columns} FROM filled WHERE event_id IS NOT NULL"""


_ALL = "event_id, user_id, ts, amount, last_view, last_click"
_PREVIOUS = _asof_sql("last_value", f"{_LOOKBACK} PRECEDING AND CURRENT ROW", _ALL)

SQL = {
    "asof_prev_per_column": _PREVIOUS,
    "asof_bucketed": _PREVIOUS,
    "asof_window": _PREVIOUS,
    "asof_prev_single": _asof_sql(
        "last_value", f"{_LOOKBACK} PRECEDING AND CURRENT ROW",
        "event_id, user_id, ts, amount, last_view",
    ),
    "asof_scan": f"""
WITH e AS (
  SELECT event_id, event_type, value, CASE WHEN event_id % 10 < 9 THEN 0 ELSE user_id END AS user_id,
    CASE WHEN event_id % 10 < 9 THEN (epoch_us(ts) // 1000) % {_BUCKET} ELSE epoch_us(ts) // 1000 END AS ms
  FROM events
),
tagged AS (
  SELECT event_id, user_id, ms, value AS amount, NULL::DOUBLE AS v, NULL::DOUBLE AS c FROM e WHERE event_type = 'purchase'
  UNION ALL
  SELECT NULL, user_id, ms, NULL, max(value) FILTER (WHERE event_type = 'view'), max(value) FILTER (WHERE event_type = 'click')
  FROM e WHERE event_type IN ('view', 'click') GROUP BY user_id, ms
),
filled AS (
  SELECT event_id, user_id, ms AS ts, amount, last_value(v IGNORE NULLS) OVER w AS last_view, last_value(c IGNORE NULLS) OVER w AS last_click
  FROM tagged WINDOW w AS (PARTITION BY user_id ORDER BY ms RANGE BETWEEN 1000 PRECEDING AND CURRENT ROW)
)
SELECT event_id, user_id, ts, amount, last_view, last_click FROM filled WHERE event_id IS NOT NULL""",
    "asof_next": _asof_sql("first_value", f"CURRENT ROW AND {_LOOKBACK} FOLLOWING", _ALL),
    "asof_unbounded": _asof_sql("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW", _ALL),
    "asof_skip_empty": _asof_sql(
        "last_value", f"{_LOOKBACK} PRECEDING AND CURRENT ROW", f"{_ALL}, NULL::DOUBLE AS last_call"
    ),
    "asof_renamed": _asof_sql(
        "last_value", f"{_LOOKBACK} PRECEDING AND CURRENT ROW",
        "user_id AS user, event_id AS purchase, ts AS at, last_view AS seen",
    ),
    "asof_two_keys": f"""
WITH e AS (
  SELECT *, (epoch_us(ts) // 1000) AS ms, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) < 50 AS half FROM events
),
r AS (
  SELECT user_id, half, ms, arg_max(event_type, {{'a': value, 'b': event_type}}) AS before, max(value) AS amount
  FROM e WHERE event_type <> 'error' GROUP BY ALL
),
m AS (
  SELECT l.event_id, l.user_id, l.half, l.ms AS ts, r.before, r.amount, r.ms AS r_ms
  FROM (SELECT * FROM e WHERE event_type = 'error') l
  ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.half = r.half AND l.ms >= r.ms
)
SELECT event_id, user_id, half, ts, CASE WHEN ts - r_ms <= {_LOOKBACK} THEN before END AS before,
  CASE WHEN ts - r_ms <= {_LOOKBACK} THEN amount END AS amount FROM m""",
    "asof_one_per_timestamp": f"""
WITH e AS (SELECT *, (epoch_us(ts) // 1000) AS ms FROM events),
l AS (SELECT DISTINCT user_id, ms // {DAY_MS} * {DAY_MS} AS ms FROM e),
tagged AS (
  SELECT user_id, ms, true AS probe, NULL::DOUBLE AS v, NULL::DOUBLE AS c FROM l
  UNION ALL
  SELECT user_id, ms, false, max(value) FILTER (WHERE event_type = 'view'),
    max(value) FILTER (WHERE event_type = 'click')
  FROM e WHERE event_type IN ('view', 'click') GROUP BY user_id, ms
),
filled AS (
  SELECT user_id, ms AS ts, probe, last_value(v IGNORE NULLS) OVER w AS last_view,
    last_value(c IGNORE NULLS) OVER w AS last_click
  FROM tagged WINDOW w AS (
    PARTITION BY user_id ORDER BY ms RANGE BETWEEN {_LOOKBACK} PRECEDING AND CURRENT ROW)
)
SELECT user_id, ts, last_view, last_click FROM filled WHERE probe""",
    "range_join_pairs": f"""
SELECT p.event_id, r.event_id AS error_id, p.user_id, (epoch_us(p.ts) // 1000) AS ts, (epoch_us(r.ts) // 1000) AS error_ts
FROM events p JOIN events r ON p.user_id = r.user_id
  AND (epoch_us(p.ts) // 1000) - (epoch_us(r.ts) // 1000) BETWEEN 0 AND {_BUCKET}
WHERE p.event_type = 'purchase' AND r.event_type = 'error'""",
}
