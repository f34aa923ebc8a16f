"""Streams over the event file, run to their end."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators.metrics import latest_per_key
from tidemark.operators.rollup import last_record, nested_usage, time_bins, trailing_window
from tidemark.plans.dataset import resolved_flows
from tidemark.queries import inputs
from tidemark.queries.inputs import BINS_SQL, FLOW_COLUMNS, RESOLVED_SQL, WINDOW_SQL
from tidemark.queries.usage import (
    PARAMS,
    _BIN_COLUMNS,
    _USAGE_COLUMNS,
    _WINDOW_COLUMNS,
    _plain_bins,
    _plain_usage,
    _plain_window,
)
from tidemark.session import cut_lineage, shared_dir
from tidemark.sources.state import latest_partition
from tidemark.streaming.detection import run_partial_bins, write_batch
from tidemark.streaming.endpoints import changed_endpoints, state_store
from tidemark.streaming.native import deduplicated, stream_files, windowed_bins

_QUARTER, _DAY = timedelta(minutes=15), timedelta(days=1)
# Which events come late: any for stored partials; for the watermark, those it still waits for.
_LATE = "event_id % 10 = 3"
_SOON = "event_id % 2 = 0 and ts > last - interval 9 minutes and ts < last"


def _folder(spark, name: str) -> str:
    stamp = f"{datetime.now():%H%M%S%f}"
    return f"{shared_dir(spark)}/{name}-{spark.sparkContext.applicationId}-{stamp}"


_BATCHES = 4
# Rows of a file of a batch at least, where a batch has more than one.
_FILE_ROWS = 200_000


def _arriving(spark, arrivals, folder: str, schema):
    """``arrivals`` as a stream of files, all of one ``arrival`` per micro-batch and the next written after them."""
    counts = dict(arrivals.where(F.col("arrival").between(0, _BATCHES - 1)).groupBy("arrival").count().collect())
    # Every batch has the same number of files, none of them empty, so that batches end where arrivals do.
    files = max(1, min(counts.get(n, 0) for n in range(_BATCHES)) // _FILE_ROWS)
    for n in range(_BATCHES):
        rows = arrivals.where(F.col("arrival") == n).drop("arrival")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(folder)
    return stream_files(spark, folder, schema, glob="*.parquet", max_files=files)


def _events(spark, sf_dir, late: str):
    """Events as a stream of files, those of a micro-batch written after those of the one before.

    Events come in the order of their ids. Those that are ``late`` come a batch later, and
    every seventh comes again in the next batch.
    """
    folder = _folder(spark, "events")
    events = inputs.table(spark, sf_dir, "events")
    batch = F.floor(F.col("event_id") * _BATCHES / events.agg(F.count(F.lit(1))).scalar())
    last = events.withColumn("batch", batch).groupBy("batch").agg(F.max("ts").alias("last"))
    timed = events.withColumn("batch", batch).join(last, "batch")
    after = F.least(F.col("batch") + F.expr(f"if({late}, 1, 0)"), F.lit(_BATCHES - 1))
    arrived = timed.withColumn("arrival", after).select(*events.columns, "arrival")
    again = arrived.where(f"event_id % 7 = 1 and arrival < {_BATCHES - 1}").withColumn("arrival", F.col("arrival") + 1)
    arrivals = cut_lineage(arrived.unionByName(again))
    return _arriving(spark, arrivals, folder, events.schema)


def _run_flows(spark, sf_dir):
    """The partial-bin job on all events; returns its output folder."""
    out = _folder(spark, "bins")
    endpoints, registry = inputs.endpoints(spark, sf_dir), inputs.registry(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")

    def to_bins(batch):
        flows = batch.withColumn("k", k).selectExpr(
            *[f"{expr} as {name}" for name, expr in FLOW_COLUMNS.items()]
        )
        flows = flows.withColumn("minute", F.floor(F.unix_millis("timestamp") / 60_000))
        resolved = resolved_flows(flows, endpoints, inputs.taxonomy(spark), registry, PARAMS)
        return time_bins(resolved, _QUARTER)

    query = run_partial_bins(
        _events(spark, sf_dir, _LATE), to_bins, f"{out}/bins", f"{out}/checkpoint",
        interval=_QUARTER, window=_DAY,
        on_window=lambda windowed, n: write_batch(nested_usage(windowed), f"{out}/usage", n),
    )
    query.awaitTermination()
    return out


def stream_bins(spark, sf_dir):
    """The partial bins of each batch."""
    bins = spark.read.parquet(f"{_run_flows(spark, sf_dir)}/bins")
    return _plain_bins(bins, F.col("batchId").cast("long").alias("batch"))


def stream_usage(spark, sf_dir):
    """Nested usage as the newest batch left it."""
    usage = spark.read.parquet(f"{_run_flows(spark, sf_dir)}/usage")
    return _plain_usage(latest_partition(usage, "batchId"))


def stream_window(spark, sf_dir):
    """The window over the partials that the stream stored."""
    bins = spark.read.parquet(f"{_run_flows(spark, sf_dir)}/bins")
    return _plain_window(trailing_window(bins, _QUARTER, _DAY, last_record(bins)))


def _native(spark, sf_dir, name, **options):
    out = _folder(spark, name)
    events = _events(spark, sf_dir, _SOON).withColumn("ts", F.col("ts").cast("timestamp"))
    unique = deduplicated(events, ["event_id"], "ts", timedelta(minutes=10))
    bins = windowed_bins(
        unique, ["user_id", "event_type"], [F.count(F.lit(1)).alias("n")],
        ts="ts", interval=_QUARTER, **options,
    )
    query = (
        bins.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True).start(f"{out}/data")
    )
    query.awaitTermination()
    return spark.read.schema(bins.schema).parquet(f"{out}/data").select(
        F.unix_millis("timeBin").alias("bin_ms"), F.unix_millis("timeBinEnd").alias("end_ms"),
        "user_id", "event_type", "n",
    )


def stream_native(spark, sf_dir):
    """Tumbling bins in Spark's own state, those the watermark has passed."""
    return _native(spark, sf_dir, "native")


def stream_sliding(spark, sf_dir):
    """Sliding windows of 15 minutes every 5."""
    return _native(spark, sf_dir, "sliding", slide=timedelta(minutes=5))


def stream_endpoints(spark, sf_dir):
    """The newest order of every customer, from the changes of a stream that keeps them in state.

    Orders come in the order of their keys, some a batch later and some again in the next one.
    """
    out = _folder(spark, "endpoints")
    orders = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("macAddress"), F.col("o_orderdate").cast("timestamp").alias("timestamp"), "o_orderkey", "o_orderpriority"
    )
    most = orders.agg(F.max("o_orderkey")).scalar()
    batch = F.least(F.floor(F.col("o_orderkey") * _BATCHES / most) + F.expr("if(o_orderkey % 10 = 3, 1, 0)"), F.lit(_BATCHES - 1))
    arrived = cut_lineage(orders.withColumn("arrival", batch))
    again = arrived.where(f"o_orderkey % 7 = 1 and arrival < {_BATCHES - 1}").withColumn("arrival", F.col("arrival") + 1)
    stream = _arriving(spark, arrived.unionByName(again), f"{out}/in", orders.schema)
    with state_store(spark):
        query = (
            changed_endpoints(stream, keep=timedelta(days=10_000)).writeStream.outputMode("update")
            .foreachBatch(lambda changes, n: write_batch(changes, f"{out}/changes", n))
            .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    newest = latest_per_key(spark.read.parquet(f"{out}/changes"), "macAddress", "batchId", ["timestamp", "o_orderkey", "o_orderpriority"])
    return newest.select("macAddress", F.unix_millis("timestamp").alias("timestamp"), "o_orderkey", "o_orderpriority")


QUERIES = {
    "stream_endpoints": stream_endpoints,
    "stream_bins": stream_bins,
    "stream_usage": stream_usage,
    "stream_window": stream_window,
    "stream_native": stream_native,
    "stream_sliding": stream_sliding,
}

_ARRIVALS_SQL = """
numbered AS (SELECT *, event_id * 4 // (SELECT count(*) FROM events) AS n FROM events),
arrived AS (SELECT * EXCLUDE (n), least(n + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END, 3) AS batch FROM numbered),
arrivals AS (
  SELECT * FROM arrived UNION ALL
  SELECT * REPLACE (batch + 1 AS batch) FROM arrived WHERE event_id % 7 = 1 AND batch < 3
)"""


def _per_batch(sql: str) -> str:
    """The SQL of one run, for each batch of the arrivals on its own."""
    changes = {
        "FROM events)": "FROM arrivals)",
        'SELECT ts AS "timestamp"': 'SELECT batch, ts AS "timestamp"',
        "PARTITION BY clientMac": "PARTITION BY batch, clientMac",
        "SELECT clientMac, serverMac, ipProto": "SELECT batch, clientMac, serverMac, ipProto",
        'SELECT "timestamp", ipProto, serverPort': 'SELECT batch, "timestamp", ipProto, serverPort',
        "SELECT time_bucket": "SELECT batch, time_bucket",
    }
    for old, new in changes.items():
        sql = sql.replace(old, new)
    return sql


_WITH_BINS = f"WITH {_ARRIVALS_SQL}, {_per_batch(RESOLVED_SQL)}, {_per_batch(BINS_SQL)}"
_WITH_WINDOW = f"{_WITH_BINS}, {WINDOW_SQL}"

SQL = {
    "stream_endpoints": """
SELECT o_custkey AS macAddress, (epoch_us(o_orderdate) // 1000) AS "timestamp", o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""",
    "stream_bins": f"{_WITH_BINS} SELECT {_BIN_COLUMNS}, batch FROM bins",
    "stream_usage": f"{_WITH_WINDOW} {_USAGE_COLUMNS}",
    "stream_window": f"{_WITH_WINDOW} SELECT {_WINDOW_COLUMNS} FROM windowed",
    "stream_native": """
WITH b AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS bin, user_id, event_type, count(*) AS n FROM events GROUP BY ALL
)
SELECT (epoch_us(bin) // 1000) AS bin_ms, (epoch_us(bin + INTERVAL 15 MINUTE) // 1000) AS end_ms, user_id, event_type, n FROM b
WHERE bin + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "stream_sliding": """
WITH b AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * s) AS bin, user_id, event_type, count(*) AS n
  FROM events CROSS JOIN (VALUES (0), (1), (2)) t(s) GROUP BY ALL
)
SELECT (epoch_us(bin) // 1000) AS bin_ms, (epoch_us(bin + INTERVAL 15 MINUTE) // 1000) AS end_ms, user_id, event_type, n FROM b
WHERE bin + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
}
