"""From deduplicated flows to per-device usage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame

from tidemark.operators.dedupe import collapse_quasi_duplicates, first_per_key
from tidemark.operators.enrich import (
    attach_endpoints,
    fill_from,
    port_based_apps,
    resolve_app_names,
    unpivot_sides,
)
from tidemark.operators.rollup import last_record, nested_usage, time_bins, trailing_window
from tidemark.session import cut_lineage

# Columns of a flow record.
FLOW_COLUMNS = (
    "timestamp", "ipProto", "serverPort", "appName", "clientBytesSent", "serverBytesSent",
)
FLOW_COUNTERS = (
    "clientBytesSent", "serverBytesSent", "clientPacketsSent", "serverPacketsSent", "timestamp",
)
SIDES = {"server": "serverMac", "client": "clientMac"}
FALLBACKS = {"clientMac": "clientMacDCS", "serverMac": "serverMacDCS"}


@dataclass(frozen=True)
class UsageParams:
    """Settings of the usage dataset."""

    interval: timedelta = timedelta(minutes=15)
    window: timedelta = timedelta(days=1)
    duplicate_keys: Sequence[str] = ()
    quasi_duplicate_keys: Sequence[str] = ("clientMac", "serverMac", "ipProto", "serverPort", "appName")
    active_classes: Sequence[str] = field(default=())
    label: str = "logicalClass"


def deduplicated_flows(flows: DataFrame, params: UsageParams) -> DataFrame:
    """Drop duplicates, then merge flows that agree on the quasi-duplicate keys."""
    if params.duplicate_keys:
        flows = first_per_key(flows, params.duplicate_keys, ["timestamp"])
    return collapse_quasi_duplicates(
        flows, params.quasi_duplicate_keys,
        max_cols=FLOW_COUNTERS, first_cols=tuple(FALLBACKS.values()),
    )


def resolved_flows(
    flows: DataFrame,
    endpoints: DataFrame,
    taxonomy: DataFrame,
    registry: DataFrame,
    params: UsageParams,
) -> DataFrame:
    """One row per flow and known device, with a standard app name."""
    sides = unpivot_sides(
        fill_from(deduplicated_flows(flows, params), FALLBACKS), FLOW_COLUMNS, SIDES
    )
    known = attach_endpoints(
        sides, endpoints, list(params.active_classes) or None, label=params.label
    )
    return port_based_apps(resolve_app_names(known, taxonomy), registry)


def device_usage(
    flows: DataFrame,
    endpoints: DataFrame,
    taxonomy: DataFrame,
    registry: DataFrame,
    stored_bins: DataFrame | None = None,
    params: UsageParams = UsageParams(),
) -> tuple[DataFrame, DataFrame]:
    """``(usage, new bins)``: nested usage of the trailing window and the partial
    bins of these flows, which are the state to keep. The bins are stored at once,
    as the window needs their bounds before their rows."""
    bins = cut_lineage(
        time_bins(
            resolved_flows(flows, endpoints, taxonomy, registry, params), params.interval, params.label
        )
    )
    every = bins if stored_bins is None else bins.unionByName(stored_bins, allowMissingColumns=True)
    windowed = trailing_window(every, params.interval, params.window, last_record(bins))
    return nested_usage(windowed), bins
