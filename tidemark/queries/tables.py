"""Snapshots, labels, metrics, listings and state tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.times import to_ms
from tidemark.operators.asof import non_null_counts as count_known
from tidemark.operators.metrics import (
    detection_metrics,
    latest_known_labels,
    latest_per_key,
    merge_metrics,
    pivot_metrics,
)
from tidemark.queries.inputs import events_ms, table
from tidemark.session import shared_dir
from tidemark.sources.listing import exists, key_of, list_keys, list_objects
from tidemark.sources.state import (
    archive,
    latest_partition,
    merge_endpoints,
    read_state,
    read_watermark,
    write_state,
    write_watermark,
)

_EARLIEST, _FIRST, _SECOND = datetime(2024, 1, 1), datetime(2024, 1, 15), datetime(2024, 2, 1)


def latest_event(spark, sf_dir):
    return latest_per_key(
        events_ms(spark, sf_dir), "user_id", "ts", ["ts", "event_id", "event_type"]
    )


def latest_label(spark, sf_dir):
    """Newest event type per user that is not an error."""
    events = events_ms(spark, sf_dir).select(
        F.col("user_id").alias("endpoint"), F.col("ts").alias("snapshotTimestamp"), "event_type"
    )
    return latest_known_labels(events, "event_type", unknown="error")


def latest_snapshot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", to_ms("o_orderdate"))
    return latest_partition(orders, "day").select("o_orderkey", "o_custkey", "day")


def metric_table(spark, sf_dir):
    """Metrics per event type, first as rows and then as columns."""
    cents = F.round(F.col("value") * 100).cast("long")
    long = (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"), F.max(cents).alias("top"))
        .unpivot("event_type", ["n", "cents", "top"], "name", "value")
    )
    return pivot_metrics(long, "event_type", ["n", "cents", "top"])


def outer_metrics(spark, sf_dir):
    """Counts of the large and of the early events, over all labels of either."""
    events = events_ms(spark, sf_dir).withColumn("label", F.col("event_type"))
    large = detection_metrics(events.where("value >= 50 and event_type <> 'view'"))
    early = events.where("event_type <> 'click'").groupBy("label").agg(
        F.min("ts").alias("first_ms")
    )
    return merge_metrics(large.withColumnRenamed("numDetections", "large"), early)


def non_null_counts(spark, sf_dir):
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        F.when(kind == "view", F.col("value")).alias("views"),
        F.when(kind == "none", F.col("value")).alias("nothing"),
        "props",
    )
    return count_known(events, events.columns)


def endpoint_merge(spark, sf_dir):
    """Stored orders of each customer updated by newer ones."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("macAddress"), to_ms("o_orderdate").alias("timestamp"),
        "o_orderkey", "o_orderpriority",
    )
    cut = F.unix_millis(F.lit("1998-01-01").cast("timestamp"))
    return merge_endpoints(orders.where(F.col("timestamp") >= cut), orders.where(F.col("timestamp") < cut))


def _stored_orders(spark, sf_dir):
    """Orders in one folder per priority; the folder's name."""
    root = f"{shared_dir(spark)}/orders-{spark.sparkContext.applicationId}-{_stamp()}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    orders.write.partitionBy("o_orderpriority").parquet(root)
    return root


def listing_where(spark, sf_dir):
    """As ``listing``, of all files with some properties instead of a prefix."""
    some = F.col("path").rlike("o_orderpriority=[13]") & (F.col("length") > 0) & (F.col("modificationTime") <= F.current_timestamp())
    return listing(spark, sf_dir, "", where=some)


def listing(spark, sf_dir, prefixes=("o_orderpriority=1", "o_orderpriority=3"), **options):
    """Orders in the files that a listing of some priorities finds."""
    root = _stored_orders(spark, sf_dir)
    found = list_objects(spark, root, prefixes, glob="*.parquet", **options)
    rows = spark.read.schema("o_orderkey bigint").option("recursiveFileLookup", "true").parquet(root)
    held = rows.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    folder = F.regexp_extract(key_of("path", root), "^o_orderpriority=(.)", 1)
    return found.join(held, "path").groupBy(folder.alias("priority")).agg(F.sum("n").alias("n"))


def listing_keys(spark, sf_dir):
    """Folders by key below the root, each listed once."""
    root = _stored_orders(spark, sf_dir)
    if not exists(spark, root, "o_orderpriority=5") or exists(spark, root, "no/data/here"):
        raise ValueError("listing is inconsistent")
    keys = list_keys(spark, root, glob="*.parquet")
    return keys.select(F.substring_index("key", "/", 1).substr(17, 1).alias("priority")).distinct()


_STATUSES = (("P", _EARLIEST), ("F", _FIRST), ("O", _SECOND))


def _written_orders(spark, sf_dir):
    """A snapshot of the orders of each status; the table's folder."""
    root = f"{shared_dir(spark)}/state-{spark.sparkContext.applicationId}-{_stamp()}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    for status, ref in _STATUSES:
        write_state(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), root, "orders", "c1", ref)
        write_watermark(spark, root, "c1", ref)
    return root


_ORDERS = "o_orderkey bigint, o_custkey bigint"


def state_tables(spark, sf_dir):
    """Three snapshots written, archived and read back: what is live, and which is newest."""
    root = _written_orders(spark, sf_dir)
    upto = read_watermark(spark, root, "c1", _SECOND, timedelta(minutes=15))
    stored = read_state(spark, root, "orders", "c1", _ORDERS)
    live = archive(stored, upto - timedelta(days=20), f"{root}-history", "orders")
    newest = read_state(spark, root, "orders", "c1", _ORDERS, latest_only=True).select("refTs").distinct()
    return live.join(newest.withColumn("newest", F.lit(True)), "refTs", "left").select(
        "o_orderkey", "o_custkey", "refTs", F.coalesce("newest", F.lit(False)).alias("newest")
    )


def state_history(spark, sf_dir):
    """The archived part of the same snapshots."""
    root = _written_orders(spark, sf_dir)
    archive(read_state(spark, root, "orders", "c1", _ORDERS), _SECOND, f"{root}-history", "orders")
    return read_state(spark, f"{root}-history", "orders", "c1", _ORDERS).select("o_orderkey", "o_custkey", "refTs")


def _stamp() -> str:
    return f"{datetime.now():%H%M%S%f}"


QUERIES = {
    "latest_event": latest_event,
    "latest_label": latest_label,
    "latest_snapshot": latest_snapshot,
    "metric_pivot": metric_table,
    "full_outer_metrics": outer_metrics,
    "non_null_counts": non_null_counts,
    "endpoint_merge": endpoint_merge,
    "listing": listing,
    "listing_where": listing_where,
    "listing_keys": listing_keys,
    "state_tables": state_tables,
    "state_history": state_history,
}

SQL = {
    "latest_event": """
SELECT user_id, (epoch_us(ts) // 1000) AS ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000) DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "latest_label": """
SELECT user_id AS endpoint, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000) DESC, event_type DESC) AS rn
  FROM events WHERE event_type <> 'error') WHERE rn = 1""",
    "latest_snapshot": """
SELECT o_orderkey, o_custkey, (epoch_us(o_orderdate) // 1000) AS day FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    "metric_pivot": """
SELECT event_type, count(*) AS n, CAST(sum(c) AS BIGINT) AS cents, max(c) AS top
FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS c FROM events) GROUP BY ALL""",
    "full_outer_metrics": """
SELECT label, large, first_ms FROM
  (SELECT event_type AS label, count(*) AS large FROM events WHERE value >= 50 AND event_type <> 'view' GROUP BY ALL)
FULL JOIN
  (SELECT event_type AS label, min((epoch_us(ts) // 1000)) AS first_ms FROM events WHERE event_type <> 'click' GROUP BY ALL)
USING (label)""",
    "non_null_counts": """
SELECT count(*) FILTER (WHERE event_type = 'view' AND value IS NOT NULL) AS views,
  count(*) FILTER (WHERE event_type = 'none') AS nothing, count(props) AS props FROM events""",
    "endpoint_merge": """
SELECT o_custkey AS macAddress, (epoch_us(o_orderdate) // 1000) AS "timestamp", o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""",
    "listing_where": """
SELECT substr(o_orderpriority, 1, 1) AS priority, count(*) AS n FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '3') GROUP BY ALL""",
    "listing": """
SELECT substr(o_orderpriority, 1, 1) AS priority, count(*) AS n FROM orders WHERE substr(o_orderpriority, 1, 1) IN ('1', '3') GROUP BY ALL""",
    "listing_keys": """SELECT DISTINCT substr(o_orderpriority, 1, 1) AS priority FROM orders""",
    "state_tables": """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN '2024-02-01T00-00-00.000' ELSE '2024-01-15T00-00-00.000' END AS "refTs",
  o_orderstatus = 'O' AS newest FROM orders WHERE o_orderstatus <> 'P'""",
    "state_history": """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN '2024-01-15T00-00-00.000' ELSE '2024-01-01T00-00-00.000' END AS "refTs"
FROM orders WHERE o_orderstatus <> 'O'""",
}
