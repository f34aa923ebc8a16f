"""Two runs of the batch detection job over events as raw files."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.plans.detection import DetectionJob, exported, run_detection
from tidemark.queries import inputs
from tidemark.queries.inputs import BINS_SQL, RESOLVED_SQL, WINDOW_SQL
from tidemark.queries.learning import _rule_models
from tidemark.queries.streams import _folder, _per_batch
from tidemark.queries.usage import _IN_VOCAB, PARAMS
from tidemark.session import cut_lineage, literal_table
from tidemark.sources.raw import ENDPOINT_ENTITY, FLOW_ENTITY

_WINDOW = timedelta(days=20)
# When the files of each arrival land, and when the run that takes them ends.
_ARRIVALS = (
    (datetime(2024, 1, 30, 23, 20), datetime(2024, 1, 30, 23, 30)),
    (datetime(2024, 1, 30, 23, 40), datetime(2024, 1, 31)),
)
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_THRESHOLD = ("http-click", 500, 10)


def _put(df, root, landed, entity):
    path = f"{root}/c1/data/{landed:%Y-%m-%dT%H-%M-%S}.000Z/{entity}"
    df.write.option("timestampFormat", _STAMP).json(path)


def _raw(spark, sf_dir, root):
    """Half of the flows in each arrival; in the second, a third of the users lose their class."""
    events = inputs.table(spark, sf_dir, "events").select("event_id", "ts")
    half = F.floor(F.col("event_id") * 2 / events.agg(F.count(F.lit(1))).scalar())
    numbered = inputs.table(spark, sf_dir, "events").withColumn("half", half)
    flows = numbered.withColumn("k", F.get_json_object("props", "$.k").cast("int")).selectExpr(
        "half", *[f"{expr} as {name}" for name, expr in inputs.FLOW_COLUMNS.items()]
    )
    flows = flows.withColumn("minute", F.floor(F.unix_millis("timestamp") / 60_000))
    fields = [c for c in flows.columns if c not in ("half", "timestamp")]
    raw = cut_lineage(flows.select("half", "timestamp", F.array(F.struct(*fields)).alias("records")))
    known = inputs.endpoints(spark, sf_dir)
    gone = F.col("macAddress").startswith("u") & (F.substring("macAddress", 2, 20).cast("long") % 3 == 0)
    for n, (landed, _) in enumerate(_ARRIVALS):
        _put(raw.where(F.col("half") == n).drop("half"), root, landed, FLOW_ENTITY)
        devices = known if n == 0 else known.where(gone).withColumn("logicalClass", F.lit("NONE"))
        data = F.struct("macAddress", "uuid", F.col("logicalClass").alias("kind")).alias("classificationData")
        _put(devices.select(F.lit(landed).alias("timestamp"), data), root, landed, ENDPOINT_ENTITY)
    return raw.drop("half").schema


def _second_run(spark, sf_dir):
    """Detections of the second run, and the folder its metrics were written to."""
    root = _folder(spark, "detection")
    schema = _raw(spark, sf_dir, f"{root}/raw")
    job = DetectionJob(
        raw_root=f"{root}/raw",
        state_root=f"{root}/state",
        flow_schema=schema,
        endpoint_schema="timestamp timestamp, classificationData struct<macAddress:string,uuid:string,kind:string>",
        endpoint_keys=["macAddress"],
        class_rules=[(name, F.col("kind") == name) for name in inputs.ACTIVE_CLASSES],
        models=_rule_models(),
        thresholds=literal_table(spark, [_THRESHOLD], "app string, minFlowClientBytes long, minFlowServerBytes long"),
        taxonomy=inputs.taxonomy(spark),
        registry=inputs.registry(spark, sf_dir),
        fmt="json",
        params=replace(PARAMS, window=_WINDOW),
    )
    metrics = f"{root}/metrics"
    for (_, end), path in zip(_ARRIVALS, (None, metrics)):
        found, _ = run_detection(spark, replace(job, metrics_path=path), "c1", end)
    return found, metrics


def detection_run(spark, sf_dir):
    """Detections of the second run: stored bins of the first, new flows and changed devices."""
    found, _ = _second_run(spark, sf_dir)
    return found.select(
        "mac", "label", "uuid", F.unix_millis("windowStart").alias("start_ms"),
        F.unix_millis("windowEnd").alias("end_ms"), F.size("apps").cast("long").alias("num_apps"),
    )


def detection_metrics(spark, sf_dir):
    """The metrics that the second run wrote."""
    _, path = _second_run(spark, sf_dir)
    metrics = spark.read.schema("label string, numDevices long, numOutOfVocab long, numDetections long").json(path)
    return metrics.select(
        "label", F.col("numDevices").alias("devices"), F.col("numOutOfVocab").alias("out_of_vocab"), F.col("numDetections").alias("detections")
    )


def detection_exported(spark, sf_dir):
    """The apps of every detection, from the JSON that is exported."""
    found, _ = _second_run(spark, sf_dir)
    app = F.explode(F.from_json("apps", "array<struct<appName: string, numFlows: bigint>>")).alias("app")
    return exported(found).select("mac", "label", "uuid", app).select("mac", "label", "uuid", "app.appName", "app.numFlows")


QUERIES = {"detection_run": detection_run, "detection_metrics": detection_metrics, "detection_exported": detection_exported}

_ARRIVED_SQL = "arrivals AS (SELECT *, event_id * 2 // (SELECT count(*) FROM events) AS batch FROM events)"
_RUNS_SQL = (
    _per_batch(RESOLVED_SQL)
    .replace(
        "AS rn FROM flows)",
        "AS rn FROM flows WHERE appName <> 'http-click' OR (clientBytesSent >= 500 AND serverBytesSent >= 10))",
    )
    .replace(
        "WHERE e.logicalClass IN",
        "WHERE NOT (batch = 1 AND e.macAddress IN (SELECT 'u' || c_custkey FROM customer WHERE c_custkey % 3 = 0)) AND e.logicalClass IN",
    )
)

_SECOND_SQL = f"""
WITH {_ARRIVED_SQL}, {_RUNS_SQL}, {_per_batch(BINS_SQL)},
kept AS (SELECT * FROM bins WHERE batch = 1 OR timeBin > TIMESTAMP '2024-01-31' - INTERVAL 20 DAY),
{WINDOW_SQL.replace("FROM bins", "FROM kept").replace("INTERVAL 1 DAY", "INTERVAL 20 DAY")},
words AS (
  SELECT DISTINCT mac, label, uuid, CASE WHEN appName IN {_IN_VOCAB} THEN appName
    ELSE side || '-out-of-vocab' END AS word
  FROM windowed WHERE numFlows > 0
), devices AS (
  SELECT mac, label, uuid, count(*) AS words, bool_or(contains(word, 'out-of-vocab')) AS oov FROM words GROUP BY ALL
)"""

SQL = {
    "detection_run": f"""{_SECOND_SQL}
SELECT mac, label, uuid, (epoch_us(any_value(windowStart)) // 1000) AS start_ms,
  (epoch_us(any_value(windowEnd)) // 1000) AS end_ms, count(DISTINCT appName) AS num_apps
FROM windowed WHERE (mac, label, uuid) IN (SELECT (mac, label, uuid) FROM devices WHERE words >= 3)
GROUP BY mac, label, uuid""",
    "detection_metrics": f"""{_SECOND_SQL}
SELECT label, count(*) AS devices, count(*) FILTER (WHERE oov) AS out_of_vocab,
  CASE WHEN count(*) FILTER (WHERE words >= 3) > 0 THEN count(*) FILTER (WHERE words >= 3) END AS detections FROM devices GROUP BY label""",
    "detection_exported": f"""{_SECOND_SQL}
SELECT mac, label, uuid, appName, numFlows FROM windowed
WHERE (mac, label, uuid) IN (SELECT (mac, label, uuid) FROM devices WHERE words >= 3)""",
}
