"""Time bins, trailing windows, nested usage and multi-hot features."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tidemark.functions.times import time_bin
from tidemark.operators.features import OUT_OF_VOCAB, device_words, multi_hot, vocabulary_words
from tidemark.operators.metrics import out_of_vocab_metrics
from tidemark.operators.rollup import (
    complete_bins,
    last_record,
    nested_usage,
    recent_bins,
    time_bins,
    trailing_window,
)
from tidemark.plans.dataset import UsageParams, device_usage, resolved_flows
from tidemark.queries import inputs
from tidemark.queries.inputs import BINS_SQL, RESOLVED_SQL, WINDOW_SQL
from tidemark.session import cut_lineage, literal_table

_QUARTER, _DAY = timedelta(minutes=15), timedelta(days=1)
_WORDS = ["client-http", "client-https", "client-purchase", "server-http", *OUT_OF_VOCAB.values()]

PARAMS = UsageParams(
    interval=_QUARTER,
    window=_DAY,
    duplicate_keys=(
        "clientMac", "serverMac", "clientMacDCS", "serverMacDCS", "ipProto", "serverPort",
        "appName", "clientBytesSent",
    ),
    quasi_duplicate_keys=("clientMac", "serverMac", "ipProto", "serverPort", "appName", "minute"),
    active_classes=inputs.ACTIVE_CLASSES,
)


def _flows(spark, sf_dir):
    minute = F.unix_millis("timestamp") / 60_000
    return inputs.flows(spark, sf_dir).withColumn("minute", F.floor(minute))


def _resolved(spark, sf_dir):
    return resolved_flows(
        _flows(spark, sf_dir), inputs.endpoints(spark, sf_dir), inputs.taxonomy(spark),
        inputs.registry(spark, sf_dir), PARAMS,
    )


def _bins(spark, sf_dir):
    return time_bins(_resolved(spark, sf_dir), _QUARTER)


def _windowed(spark, sf_dir):
    bins = cut_lineage(_bins(spark, sf_dir))
    return trailing_window(bins, _QUARTER, _DAY, last_record(bins))


def _plain_bins(df, *more):
    return df.select(
        F.unix_millis("timeBin").alias("bin_ms"), "mac", "appName", "side", "uuid", "label",
        F.col("clientBytesInterval").alias("client_bytes"),
        F.col("serverBytesInterval").alias("server_bytes"),
        F.col("totalBytesInterval").alias("total_bytes"),
        F.col("numFlowsInterval").alias("num_flows"),
        *more,
    )


def _plain_window(df):
    return df.select(
        "mac", "appName", "side", "label", "uuid",
        F.unix_millis("windowStart").alias("start_ms"), F.unix_millis("windowEnd").alias("end_ms"),
        F.col("clientBytesWindow").alias("client_bytes"),
        F.col("serverBytesWindow").alias("server_bytes"),
        F.col("totalBytesWindow").alias("total_bytes"),
        F.col("numFlowsWindow").alias("num_flows"),
    )


def _plain_usage(df):
    app = F.transform(
        "apps",
        lambda a: F.concat_ws(
            "|", a["appName"], a["totalClientBytes"].cast("string"), a["totalServerBytes"].cast("string"),
            a["totalBytes"].cast("string"), a["numFlows"].cast("string"),
        ),
    )
    return df.select(
        "mac", "label", "uuid", F.unix_millis("windowStart").alias("start_ms"),
        F.unix_millis("windowEnd").alias("end_ms"), F.concat_ws(",", app).alias("apps"),
    )


def event_bins(spark, sf_dir):
    """All events in bins of 15 minutes per user and type."""
    cents = F.round(F.col("value") * 100).cast("long")
    return (
        inputs.table(spark, sf_dir, "events")
        .groupBy(F.unix_millis(time_bin("ts", _QUARTER)).alias("bin_ms"), "user_id", "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))
    )


def flow_resolution(spark, sf_dir):
    return _resolved(spark, sf_dir).select(
        "mac", "side", "uuid", "logicalClass", "appName", "ipProto", "serverPort",
        "clientBytesSent", "serverBytesSent", F.unix_millis("timestamp").alias("ms"),
    )


def merged_partials(spark, sf_dir):
    """The window over the bins of two runs, the second with late rows."""
    resolved = _resolved(spark, sf_dir)
    late = F.col("clientBytesSent") < F.col("serverBytesSent")
    first, second = (time_bins(resolved.where(c), _QUARTER) for c in (late, ~late))
    both = cut_lineage(first.unionByName(second))
    return _plain_window(trailing_window(both, _QUARTER, _DAY, last_record(both)))


def recent_state(spark, sf_dir):
    """Bins that a window ending at the last event can still need."""
    end = inputs.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return _plain_bins(recent_bins(_bins(spark, sf_dir), end, _DAY))


def complete_only(spark, sf_dir):
    bins = cut_lineage(_bins(spark, sf_dir))
    return _plain_bins(complete_bins(bins, _QUARTER, last_record(bins)))


def device_usage_query(spark, sf_dir):
    """The whole dataset plan, from raw flows to nested usage."""
    usage, _ = device_usage(
        _flows(spark, sf_dir), inputs.endpoints(spark, sf_dir), inputs.taxonomy(spark),
        inputs.registry(spark, sf_dir), None, PARAMS,
    )
    return _plain_usage(usage)


def multi_hot_words(spark, sf_dir):
    usage = nested_usage(_windowed(spark, sf_dir))
    table = literal_table(spark, [(w,) for w in _WORDS], "word string")
    return vocabulary_words(usage, table).select("mac", "label", "uuid", F.concat_ws(",", "words").alias("words"))


def multi_hot_vectors(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    rows = multi_hot(nested_usage(_windowed(spark, sf_dir)), _WORDS)
    bits = F.transform(vector_to_array("features"), lambda x: x.cast("int").cast("string"))
    return rows.select("mac", "label", "uuid", F.concat_ws("", bits).alias("bits"))


def out_of_vocab(spark, sf_dir):
    vocabulary = literal_table(
        spark, [(label, w) for label in inputs.ACTIVE_CLASSES for w in _WORDS], "label string, word string"
    )
    return out_of_vocab_metrics(device_words(_windowed(spark, sf_dir), vocabulary)).select(
        "label", F.col("numDevices").alias("devices"), F.col("numOutOfVocab").alias("out_of_vocab")
    )


QUERIES = {
    "time_bins": event_bins,
    "flow_resolution": flow_resolution,
    "flow_bins": lambda spark, sf_dir: _plain_bins(_bins(spark, sf_dir)),
    "complete_bins": complete_only,
    "recent_bins": recent_state,
    "trailing_window": lambda spark, sf_dir: _plain_window(_windowed(spark, sf_dir)),
    "merged_partials": merged_partials,
    "nested_usage": lambda spark, sf_dir: _plain_usage(nested_usage(_windowed(spark, sf_dir))),
    "device_usage": device_usage_query,
    "multi_hot": multi_hot_words,
    "multi_hot_vectors": multi_hot_vectors,
    "out_of_vocab": out_of_vocab,
}

_BIN_COLUMNS = """(epoch_us(timeBin) // 1000) AS bin_ms, mac, appName, side, uuid, label, clientBytes AS client_bytes,
  serverBytes AS server_bytes, clientBytes + serverBytes AS total_bytes, numFlows AS num_flows"""
_WINDOW_COLUMNS = """mac, appName, side, label, uuid, (epoch_us(windowStart) // 1000) AS start_ms,
  (epoch_us(windowEnd) // 1000) AS end_ms, clientBytes AS client_bytes, serverBytes AS server_bytes,
  clientBytes + serverBytes AS total_bytes, numFlows AS num_flows"""
_WITH_BINS = f"WITH {RESOLVED_SQL}, {BINS_SQL}"
_WITH_WINDOW = f"{_WITH_BINS}, {WINDOW_SQL}"
_USAGE_COLUMNS = """SELECT mac, label, uuid, (epoch_us(windowStart) // 1000) AS start_ms, (epoch_us(windowEnd) // 1000) AS end_ms,
  string_agg(concat_ws('|', appName, clientBytes, serverBytes, clientBytes + serverBytes, numFlows), ','
    ORDER BY appName) AS apps
FROM windowed GROUP BY mac, label, uuid, windowStart, windowEnd"""
_USAGE = f"{_WITH_WINDOW} {_USAGE_COLUMNS}"
_IN_VOCAB = "(" + ", ".join(f"'{w}'" for w in _WORDS) + ")"
_WITH_WORDS = f"""{_WITH_WINDOW},
words AS (
  SELECT DISTINCT mac, label, uuid, CASE WHEN appName IN {_IN_VOCAB} THEN appName
    ELSE side || '-out-of-vocab' END AS word
  FROM windowed WHERE numFlows > 0
)"""
_BITS = " || ".join(f"CAST(max(CAST(word = '{w}' AS INTEGER)) AS VARCHAR)" for w in _WORDS)

SQL = {
    "time_bins": """
SELECT (epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) // 1000) AS bin_ms, user_id, event_type, count(*) AS n,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY ALL""",
    "flow_resolution": f"""WITH {RESOLVED_SQL}
SELECT mac, side, uuid, logicalClass, appName, ipProto, serverPort, clientBytesSent, serverBytesSent,
  (epoch_us("timestamp") // 1000) AS ms FROM resolved""",
    "flow_bins": f"{_WITH_BINS} SELECT {_BIN_COLUMNS} FROM bins",
    "complete_bins": f"{_WITH_WINDOW} SELECT {_BIN_COLUMNS} FROM done",
    "recent_bins": f"""{_WITH_BINS} SELECT {_BIN_COLUMNS} FROM bins
WHERE timeBin > (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
    "trailing_window": f"{_WITH_WINDOW} SELECT {_WINDOW_COLUMNS} FROM windowed",
    "merged_partials": f"{_WITH_WINDOW} SELECT {_WINDOW_COLUMNS} FROM windowed",
    "nested_usage": _USAGE,
    "device_usage": _USAGE,
    "multi_hot": f"""{_WITH_WORDS}
SELECT mac, label, uuid, string_agg(word, ',' ORDER BY word) AS words FROM words GROUP BY ALL""",
    "multi_hot_vectors": f"{_WITH_WORDS} SELECT mac, label, uuid, {_BITS} AS bits FROM words GROUP BY ALL",
    "out_of_vocab": f"""{_WITH_WORDS},
devices AS (SELECT mac, label, uuid, bool_or(contains(word, 'out-of-vocab')) AS oov FROM words GROUP BY ALL)
SELECT label, count(*) AS devices, count(*) FILTER (WHERE oov) AS out_of_vocab FROM devices GROUP BY ALL""",
}
