"""The incremental detection job, as one batch run over files."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import start_time
from tidemark.operators.enrich import assign_class
from tidemark.operators.features import device_words, words_to_vector
from tidemark.operators.histograms import BoostedTrees
from tidemark.operators.learning import positives, score_classes
from tidemark.operators.metrics import detection_metrics, merge_metrics, out_of_vocab_metrics
from tidemark.operators.rollup import last_record, recent_bins, time_bins, trailing_window
from tidemark.plans.dataset import UsageParams, resolved_flows
from tidemark.session import cut_lineage, literal_table
from tidemark.sources.raw import (
    ENDPOINT_ENTITY,
    FLOW_ENTITY,
    discover,
    endpoint_rows,
    flow_rows,
    new_watermark,
    read_raw,
)
from tidemark.sources.state import (
    append_jdbc,
    append_metrics,
    archive_all,
    merge_endpoints,
    read_state,
    read_watermark,
    ref_time,
    write_state,
    write_watermark,
)

_LOG = logging.getLogger(__name__)

DETECTION_COLUMNS = ("mac", "label", "windowStart", "windowEnd", "apps", "uuid")
BINS_SCHEMA = (
    "timeBin timestamp, mac string, appName string, side string, uuid string, label string, "
    "clientBytesInterval bigint, serverBytesInterval bigint, numFlowsInterval bigint, "
    "lastTimestamp timestamp, totalBytesInterval bigint"
)


class ClassModel(NamedTuple):
    """Model of one class and the vocabulary its features are built on."""

    vocabulary: Sequence[str]
    model: Model | BoostedTrees


@dataclass(frozen=True)
class DetectionJob:
    """Inputs, rules and outputs of the detection job."""

    raw_root: str
    state_root: str
    flow_schema: str
    endpoint_schema: str
    endpoint_keys: Sequence[str]
    class_rules: Sequence[tuple[str, Column]]
    models: Mapping[str, ClassModel]
    thresholds: DataFrame
    taxonomy: DataFrame
    registry: DataFrame
    default_client_bytes: int = 0
    default_server_bytes: int = 0
    fmt: str = "avro"
    params: UsageParams = field(default_factory=UsageParams)
    metrics_path: str | None = None
    jdbc_url: str | None = None
    jdbc_table: str = "detections"
    history_root: str | None = None
    keep: timedelta = timedelta(days=30)
    keep_endpoints: timedelta = timedelta(days=90)


def score_usage(
    windowed: DataFrame, models: Mapping[str, ClassModel]
) -> tuple[DataFrame, DataFrame]:
    """``(detections, metrics per label)`` of a trailing window."""
    vocabulary = literal_table(
        windowed.sparkSession,
        [(label, word) for label, m in models.items() for word in m.vocabulary],
        "label string, word string",
    )
    words = cut_lineage(device_words(windowed.where(F.col("label").isin(*models)), vocabulary))
    scored = score_classes(words, {label: _scorer(m) for label, m in models.items()})
    detections = positives(scored, DETECTION_COLUMNS)
    return detections, merge_metrics(out_of_vocab_metrics(words), detection_metrics(detections))


def run_detection(
    spark: SparkSession, job: DetectionJob, customer: str, end: datetime
) -> tuple[DataFrame, DataFrame] | None:
    """Process the files that arrived since the last run and write all outputs.

    Returns the stored detections and metrics, or None if no file arrived. The
    watermark is written last, so a failed run is repeated.
    """
    params = job.params
    watermark = read_watermark(spark, job.state_root, customer, end, params.interval)
    start = start_time(watermark, end, params.interval)
    files = discover(spark, job.raw_root, customer, start, end, watermark, job.fmt)
    files = files.where(F.col("ts") < F.lit(end))
    if files.isEmpty():
        return None
    upto = new_watermark(files, start).first()["timestamp"]

    def raw(entity: str, schema: str) -> DataFrame:
        return read_raw(
            spark, job.raw_root, customer, entity, schema, start, end, watermark, upto, fmt=job.fmt
        )

    arrived = endpoint_rows(raw(ENDPOINT_ENTITY, job.endpoint_schema), list(job.endpoint_keys))
    known = read_state(spark, job.state_root, "endpoint", customer, arrived.schema, latest_only=True)
    write_state(merge_endpoints(arrived, known), job.state_root, "endpoint", customer, upto)
    merged = read_state(spark, job.state_root, "endpoint", customer, arrived.schema, at=upto)
    # A device has the class of its newest record, or none, whatever its older ones had.
    endpoints = assign_class(merged.select(*arrived.columns), job.class_rules, params.label)

    flows = flow_rows(
        raw(FLOW_ENTITY, job.flow_schema), job.thresholds,
        job.default_client_bytes, job.default_server_bytes,
    )
    resolved = resolved_flows(flows, endpoints, job.taxonomy, job.registry, params)
    write_state(time_bins(resolved, params.interval, params.label), job.state_root, "etlBins", customer, upto)
    stored = read_state(spark, job.state_root, "etlBins", customer, BINS_SCHEMA)
    fresh = F.col("refTs") == ref_time(upto)
    bins = recent_bins(stored, F.lit(end), params.window, fresh)
    windowed = trailing_window(bins, params.interval, params.window, last_record(stored.where(fresh)))

    detections, metrics = score_usage(windowed, job.models)
    write_state(detections, job.state_root, "detections", customer, upto)
    found = read_state(spark, job.state_root, "detections", customer, detections.schema, at=upto)
    metrics = cut_lineage(metrics)
    if job.jdbc_url:
        append_jdbc(exported(found), job.jdbc_url, job.jdbc_table)
    if job.metrics_path:
        failure = append_metrics(metrics, job.metrics_path)
        if failure is not None:
            _LOG.error("metrics of %s up to %s were not written: %s", customer, upto, failure)
    write_watermark(spark, job.state_root, customer, upto)
    if job.history_root:
        _retire(spark, job, customer, upto, {"endpoint": arrived.schema, "etlBins": BINS_SCHEMA, "detections": detections.schema})
    return found, metrics


def exported(detections: DataFrame) -> DataFrame:
    """Detections as a relational table takes them: the nested apps as JSON."""
    return detections.withColumn("apps", F.to_json("apps"))


def _retire(spark: SparkSession, job: DetectionJob, customer: str, upto: datetime, schemas: Mapping) -> None:
    """Copy snapshots past their time to the history tables."""
    tables = {entity: read_state(spark, job.state_root, entity, customer, schema) for entity, schema in schemas.items()}
    archive_all(tables, upto, job.history_root, job.keep, job.keep_endpoints)


def _scorer(class_model: ClassModel) -> _Scorer:
    return _TreeScorer(class_model) if isinstance(class_model.model, BoostedTrees) else _Scorer(class_model)


class _Scorer:
    """Features, then the model, for rows with ``words``."""

    def __init__(self, class_model: ClassModel):
        self.class_model = class_model

    def transform(self, df: DataFrame) -> DataFrame:
        vocabulary, model = self.class_model
        return model.transform(words_to_vector(df, vocabulary))


class _TreeScorer(_Scorer):
    """Trees as an expression on ``words``; no features are built."""

    def predicted(self, df: DataFrame) -> Column:
        vocabulary, model = self.class_model
        return model.predicted_by_words(vocabulary)
