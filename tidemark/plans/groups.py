"""Groups of endpoints by the features of their snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import AttributeSlice, unit_of_entries
from tidemark.operators.cluster import dbscan, expand_clusters
from tidemark.operators.features import vector_sum
from tidemark.operators.metrics import cluster_quality, latest_known_labels, pivot_metrics
from tidemark.operators.similarity import dedupe_vectors
from tidemark.session import cut_lineage, literal_table

# The grid of neighbour distances and the distance functions.
EPS_GRID = (0.001, 0.01, 0.015, 0.065, 0.115, 0.165, 0.215, 0.265)
DISTANCES = ("global", "per_attribute")
METRIC_NAMES = (
    "clustered", "clusters", "completeness", "epsilon", "homogeneity", "minWeight", "noise", "purity",
)


@dataclass(frozen=True)
class ClusterParams:
    """Settings of one run."""

    eps: float = 0.115
    min_weight: int = 5
    distance: str = "global"
    layout: Sequence[AttributeSlice] = ()
    euclidean: bool = False
    cells: str = "prefix"
    faithful_zero_distance: bool = False


class Clustered(NamedTuple):
    """Results of a run."""

    snapshots: DataFrame
    endpoints: DataFrame
    metrics: DataFrame
    per_cluster: DataFrame


def cluster_endpoints(
    snapshots: DataFrame,
    params: ClusterParams,
    *,
    label: str | None = None,
    vector_col: str = "sparseFeatures",
) -> Clustered:
    """Cluster endpoints and carry the cluster to each of their snapshots.

    ``snapshots`` has ``endpoint``, ``snapshotTimestamp`` and a vector column;
    with a ``label`` column the clusters are compared with the newest known label
    of each endpoint. Endpoints without a cluster get a null ``clusterId``.
    """
    features = vector_sum(snapshots, "endpoint", vector_col)
    endpoints = cut_lineage(
        _assigned(features, params, [params.eps]).drop("eps")
    )
    metrics, per_cluster = cluster_quality(endpoints, _labels(snapshots, label))
    settings = literal_table(
        snapshots.sparkSession,
        [("epsilon", float(params.eps)), ("minWeight", float(params.min_weight))],
        "name string, value double",
    )
    return Clustered(
        snapshots.join(endpoints, "endpoint"), endpoints, metrics.unionByName(settings), per_cluster
    )


def grid_search(
    snapshots: DataFrame,
    label: str,
    layout: Sequence[AttributeSlice],
    *,
    min_weight: int,
    metric: str = "homogeneity",
    eps_grid: Sequence[float] = EPS_GRID,
    distances: Sequence[str] = DISTANCES,
    default: ClusterParams | None = None,
    euclidean: bool = False,
    cells: str = "prefix",
    vector_col: str = "sparseFeatures",
) -> tuple[ClusterParams, DataFrame]:
    """Parameters with the best metric, and one row of metrics per grid point.

    All eps of a distance share one comparison of the vectors. Of equal scores the
    first grid point wins; without any score the default parameters are returned.
    Euclidean runs only try the global distance.
    """
    if euclidean:
        distances = [d for d in distances if d == "global"]
    features = cut_lineage(vector_sum(snapshots, "endpoint", vector_col))
    labels = _labels(snapshots, label)
    spark = snapshots.sparkSession
    parts = []
    for distance in distances:
        params = ClusterParams(
            min_weight=min_weight, distance=distance, layout=layout, euclidean=euclidean, cells=cells
        )
        found = cut_lineage(_assigned(features, params, eps_grid))
        metrics, _ = cluster_quality(found, labels, by=["eps"])
        parts.append(metrics.withColumn("distance", F.lit(distance)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    points = [
        (f"eps={e},min_weight={min_weight},distance={d}", float(e), d, n)
        for n, (e, d) in enumerate((e, d) for e in eps_grid for d in distances)
    ]
    grid = literal_table(spark, points, "param string, eps double, distance string, position int")
    settings = grid.select(
        "param",
        F.explode(
            F.create_map(
                F.lit("epsilon"), F.col("eps"), F.lit("minWeight"), F.lit(float(min_weight))
            )
        ).alias("name", "value"),
    )
    long = found.join(grid, ["eps", "distance"]).select("param", "name", "value")
    wide = cut_lineage(pivot_metrics(long.unionByName(settings), "param", METRIC_NAMES))
    best = (
        wide.join(grid, "param")
        .where(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), "position")
        .select("eps", "distance")
        .first()
    )
    if best is None:
        return default or ClusterParams(min_weight=min_weight, layout=layout), wide
    chosen = ClusterParams(
        eps=best["eps"], min_weight=min_weight, distance=best["distance"], layout=layout,
        euclidean=euclidean, cells=cells,
    )
    return chosen, wide


def _assigned(features: DataFrame, params: ClusterParams, eps: Sequence[float]) -> DataFrame:
    if params.distance not in DISTANCES:
        raise ValueError(f"distance must be one of {DISTANCES}")
    if params.distance == "per_attribute" and params.euclidean:
        raise ValueError("the euclidean metric supports the global distance only")
    if params.distance == "per_attribute" and not params.layout:
        raise ValueError("the per-attribute distance needs an attribute layout")
    layout = params.layout if params.distance == "per_attribute" else None
    entries = unit_of_entries(F.col("entries"), layout).alias("entries")
    vectors = cut_lineage(features.select(F.col("endpoint").alias("id"), entries))
    points = dedupe_vectors(vectors)
    clusters = dbscan(
        points, eps, params.min_weight,
        metric="euclidean" if params.euclidean else "cosine",
        cells=params.cells,
        faithful_zero_distance=params.faithful_zero_distance,
    )
    return expand_clusters(clusters, vectors, points)


def _labels(snapshots: DataFrame, label: str | None) -> DataFrame:
    if label is None:
        none = F.lit(None).cast("string").alias("label")
        return snapshots.select("endpoint", none).limit(0)
    known = latest_known_labels(snapshots, label)
    return known.select("endpoint", F.col(label).alias("label"))
