"""Vector sums, cosine neighbours and clusters."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.functions.vectors import as_array, attribute_layout, l2_norm, vector_size
from tidemark.operators.asof import asof_join
from tidemark.operators.cluster import connected_components, dbscan, expand_clusters
from tidemark.operators.features import vector_sum
from tidemark.operators.similarity import (
    cosine_pairs,
    dedupe_vectors,
    unit_vectors,
    unit_vectors_long,
    vector_members,
)
from tidemark.plans.groups import EPS_GRID, ClusterParams, cluster_endpoints, grid_search
from tidemark.queries.inputs import events_ms, table
from tidemark.session import literal_table, stored

_EPS, _MIN = 0.65, 3
_PAUSE = 21_600_000
#: All distances of the library's grid, and some at which the supplied vectors have neighbours.
_GRID = (*EPS_GRID, 0.5, 0.6, 0.65)
_SPARSE_EPS, _TIGHT_EPS = 0.45, 0.3
_EUCLID = 0.999
_COPY = 10_000_000
_LAYOUT = attribute_layout([("front", 32), ("back", 32)], {"front": 2.0, "back": 1.0})


def _vectors(spark, sf_dir, layout=None):
    return unit_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", layout)


def _with_copies(spark, sf_dir):
    """Every embedding twice, the copy at twice its length."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    copies = rows.select(
        (F.col("vec_id") + _COPY).alias("vec_id"), F.transform("embedding", lambda x: x * 2).alias("embedding")
    )
    return unit_vectors(rows.unionByName(copies), "vec_id", "embedding")


def _orders_by_part(spark, sf_dir):
    """Each order as a sparse vector of the quantities of its parts."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey")
    quantities = items.agg(F.sum("l_quantity").alias("quantity"))
    return unit_vectors_long(quantities, "l_orderkey", "l_partkey", "quantity")


def _snapshots(spark, sf_dir):
    """Two snapshots per embedding; the label is only known in the first."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("endpoint"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("sparseFeatures"),
        F.col("label").cast("string").alias("label"),
    )
    first = rows.withColumn("snapshotTimestamp", F.lit(1))
    second = rows.withColumns({"snapshotTimestamp": F.lit(2), "label": F.lit("unknown")})
    return first.unionByName(second)


def vector_sums(spark, sf_dir):
    sums = vector_sum(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return sums.select("label", F.inline("entries")).select("label", "dim", F.round("val", 4).alias("total"))


def vector_norms(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    values = as_array(rows, "embedding")
    return rows.select(
        "vec_id", vector_size(rows, "embedding").alias("size"), F.round(l2_norm(values), 6).alias("norm")
    )


def attribute_norms(spark, sf_dir):
    """Length of each attribute's block after scaling; the weights' shares."""
    blocks = _vectors(spark, sf_dir, _LAYOUT).select("id", F.explode("entries").alias("e"))
    return blocks.groupBy(F.col("id").alias("vec_id"), (F.col("e.dim") < 32).alias("front")).agg(
        F.round(F.sum(F.col("e.val") * F.col("e.val")), 6).alias("share")
    )


def vector_dedupe(spark, sf_dir):
    points = dedupe_vectors(_with_copies(spark, sf_dir))
    return points.select(F.col("id").alias("vec_id"), F.col("weight"))


def vector_inverse(spark, sf_dir):
    vectors = _with_copies(spark, sf_dir)
    return vector_members(vectors, dedupe_vectors(vectors))


def cosine(spark, sf_dir):
    return cosine_pairs(_vectors(spark, sf_dir), _EPS)


def attribute(spark, sf_dir):
    return cosine_pairs(_vectors(spark, sf_dir, _LAYOUT), _EPS)


def cosine_sparse(spark, sf_dir):
    return cosine_pairs(_orders_by_part(spark, sf_dir), _SPARSE_EPS, cells="prefix")


def _clusters(vectors, eps, min_weight, **options):
    # Read for the points, for their representatives and for the members.
    vectors = stored(vectors, "vectors")
    points = stored(dedupe_vectors(vectors), "points")
    found = stored(dbscan(points, eps, min_weight, kept=True, **options), "clusters")
    return expand_clusters(found, vectors, points, "vec_id").select(
        "vec_id", F.col("clusterId").alias("cluster")
    )


def dbscan_clusters(spark, sf_dir):
    return _clusters(_vectors(spark, sf_dir), _EPS, _MIN)


def dbscan_weighted(spark, sf_dir):
    """Every vector counts twice, so that one neighbour makes it core."""
    return _clusters(_with_copies(spark, sf_dir), _EPS, _MIN)


def dbscan_euclidean(spark, sf_dir):
    return _clusters(_vectors(spark, sf_dir), _EUCLID, 2, metric="euclidean")


def components(spark, sf_dir):
    """Sessions: chains of a user's events, each at most six hours after the one before."""
    events = events_ms(spark, sf_dir).select("user_id", "ts", "event_id")
    earlier = events.select("user_id", (F.col("ts") + 1).alias("ts"), F.col("event_id").alias("before"))
    linked = asof_join(events, earlier, ["user_id"], lookback_ms=_PAUSE, bucket_ms=_PAUSE)
    edges = linked.where(F.col("before").isNotNull())
    return connected_components(edges.select(F.col("event_id").alias("u"), F.col("before").alias("v")))


def cluster_assignments(spark, sf_dir):
    params = ClusterParams(eps=_EPS, min_weight=_MIN, cells="anchors")
    found = cluster_endpoints(_snapshots(spark, sf_dir), params, label="label")
    return found.snapshots.select("endpoint", "snapshotTimestamp", "label", "clusterId")


def cluster_metrics(spark, sf_dir):
    params = ClusterParams(eps=_EPS, min_weight=_MIN, cells="anchors")
    found = cluster_endpoints(_snapshots(spark, sf_dir), params, label="label")
    return found.metrics.select("name", F.round("value", 6).alias("value"))


def per_cluster_metrics(spark, sf_dir):
    params = ClusterParams(eps=_EPS, min_weight=_MIN, cells="anchors")
    found = cluster_endpoints(_snapshots(spark, sf_dir), params, label="label")
    return found.per_cluster.select("clusterId", "name", F.round("value", 6).alias("value"))


def dbscan_sparse(spark, sf_dir):
    """Clusters of orders by their parts: many sparse vectors in prefix cells."""
    return _clusters(_orders_by_part(spark, sf_dir), _TIGHT_EPS, 2, cells="prefix")


def grid_best(spark, sf_dir):
    """The grid point with the best homogeneity, the first of equal ones."""
    best, _ = grid_search(
        _snapshots(spark, sf_dir), "label", _LAYOUT, min_weight=_MIN, eps_grid=_GRID, cells="anchors"
    )
    return literal_table(spark, [(best.eps, best.distance)], "eps double, distance string")


def grid(spark, sf_dir):
    """Metrics of all grid points over the whole grid and both distances."""
    _, metrics = grid_search(
        _snapshots(spark, sf_dir), "label", _LAYOUT, min_weight=_MIN, eps_grid=_GRID, cells="anchors"
    )
    return metrics.select("param", *[F.round(c, 6).alias(c) for c in metrics.columns if c != "param"])


QUERIES = {
    "vector_sum": vector_sums,
    "vector_norms": vector_norms,
    "attribute_norms": attribute_norms,
    "vector_dedupe": vector_dedupe,
    "vector_members": vector_inverse,
    "cosine_pairs": cosine,
    "attribute_pairs": attribute,
    "cosine_pairs_sparse": cosine_sparse,
    "dbscan_clusters": dbscan_clusters,
    "dbscan_weighted": dbscan_weighted,
    "dbscan_euclidean": dbscan_euclidean,
    "connected_components": components,
    "cluster_assignments": cluster_assignments,
    "cluster_metrics": cluster_metrics,
    "per_cluster_metrics": per_cluster_metrics,
    "dbscan_sparse": dbscan_sparse,
    "grid_search": grid,
    "grid_search_best": grid_best,
}

_UNIT = """
u AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_dot_product(
    CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS v,
    list_transform(CAST(embedding[1:32] AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(
      CAST(embedding[1:32] AS DOUBLE[]), CAST(embedding[1:32] AS DOUBLE[])))) AS f,
    list_transform(CAST(embedding[33:64] AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(
      CAST(embedding[33:64] AS DOUBLE[]), CAST(embedding[33:64] AS DOUBLE[])))) AS b
  FROM embeddings
)"""


def _cluster_sql(near: str, minimum: int, weight: int = 1) -> str:
    """Clusters of the embeddings with a condition for neighbours."""
    return f"""
WITH RECURSIVE {_UNIT},
pairs AS MATERIALIZED (
  SELECT a.vec_id AS i, b.vec_id AS j FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE {near}
),
{_cluster_steps(minimum, weight)}"""


def _cluster_steps(minimum: int, weight: int = 1) -> str:
    """Clusters of ``u`` over ``pairs`` in both directions, named after the least core id."""
    return f"""edges AS MATERIALIZED (SELECT i, j FROM pairs UNION ALL SELECT j, i FROM pairs),
core AS MATERIALIZED (
  SELECT vec_id FROM u LEFT JOIN edges ON vec_id = i
  GROUP BY vec_id HAVING {weight} * (1 + count(j)) >= {minimum}
),
reach(id, name) AS (
  SELECT vec_id, vec_id FROM core
  UNION
  SELECT e.j, r.name FROM reach r JOIN edges e ON r.id = e.i JOIN core c ON c.vec_id = e.j
),
named AS (SELECT id, min(name) AS cluster FROM reach GROUP BY id),
border AS (
  SELECT e.i AS id, min(n.cluster) AS cluster FROM edges e JOIN named n ON e.j = n.id
  WHERE e.i NOT IN (SELECT vec_id FROM core) GROUP BY e.i
),
clusters AS (
  SELECT vec_id, label, cluster FROM u
  LEFT JOIN (SELECT * FROM named UNION ALL SELECT * FROM border) c ON vec_id = c.id
)"""


_DOT = "list_dot_product(a.v, b.v)"
_NEAR = f"round(greatest(1 - {_DOT}, 0), 4) < {_EPS}"
_CLUSTERS = _cluster_sql(_NEAR, _MIN)
_DISTANCE = {
    "global": f"1 - {_DOT}",
    "per_attribute": "1 - (2 * list_dot_product(a.f, b.f) + list_dot_product(a.b, b.b)) / 3",
}


def _grid_row(eps: float, distance: str) -> str:
    """One row of metrics: clusters at ``eps``, compared with the labels."""
    clusters = _cluster_sql(f"round(greatest({_DISTANCE[distance]}, 0), 4) < {eps}", _MIN)
    return f"""
SELECT * FROM ({clusters},
t AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM clusters WHERE cluster IS NOT NULL GROUP BY ALL),
c AS (SELECT cluster, sum(n) AS n, max(n) AS top FROM t GROUP BY ALL),
l AS (SELECT label, sum(n) AS n FROM t GROUP BY ALL),
s AS (
  SELECT (SELECT sum(n) FROM t) AS total, (SELECT sum(top) FROM c) AS top,
    (SELECT sum(n * ln(n)) FROM t) AS cells, (SELECT sum(n * ln(n)) FROM c) AS rs, (SELECT sum(n * ln(n)) FROM l) AS cs
),
h AS (SELECT *, ln(total) - cs / total AS hl, ln(total) - rs / total AS hc FROM s)
SELECT 'eps={eps},min_weight={_MIN},distance={distance}' AS param, coalesce(total, 0) AS clustered,
  CAST((SELECT count(*) FROM c) AS DOUBLE) AS clusters,
  round(CASE WHEN hc <= 1e-12 THEN 1 ELSE 1 - ((cs - cells) / total) / hc END, 6) AS completeness,
  CAST({eps} AS DOUBLE) AS epsilon,
  round(CASE WHEN hl <= 1e-12 THEN 1 ELSE 1 - ((rs - cells) / total) / hl END, 6) AS homogeneity,
  CAST({_MIN} AS DOUBLE) AS "minWeight",
  CAST((SELECT count(*) FROM clusters WHERE cluster IS NULL) AS DOUBLE) AS noise,
  round(top / total, 6) AS purity
FROM h)"""

_SPARSE_UNIT = """q AS (
  SELECT l_orderkey AS id, l_partkey AS dim, sum(l_quantity) AS val FROM lineitem GROUP BY ALL HAVING val <> 0
),
e AS (SELECT id, dim, val / sqrt(sum(val * val) OVER (PARTITION BY id)) AS val FROM q)"""

_GRID_SQL = " UNION ALL ".join(_grid_row(eps, distance) for eps in _GRID for distance in ("global", "per_attribute"))

SQL = {
    "dbscan_sparse": f"""
WITH RECURSIVE {_SPARSE_UNIT},
u AS (SELECT DISTINCT id AS vec_id, 0 AS label FROM e),
pairs AS MATERIALIZED (
  SELECT i, j FROM (
    SELECT a.id AS i, b.id AS j, round(greatest(1 - sum(a.val * b.val), 0), 4) AS dist
    FROM e a JOIN e b ON a.dim = b.dim AND a.id < b.id GROUP BY ALL) WHERE dist < {_TIGHT_EPS}
),
{_cluster_steps(2)}
SELECT vec_id, cluster FROM clusters""",
    "grid_search_best": f"""
SELECT epsilon AS eps, regexp_extract(param, 'distance=(.*)', 1) AS distance FROM ({_GRID_SQL})
WHERE homogeneity IS NOT NULL ORDER BY homogeneity DESC, epsilon, param LIMIT 1""",
    "vector_sum": """
SELECT label, CAST(dim - 1 AS INTEGER) AS dim, round(sum(CAST(x AS DOUBLE)), 4) AS total FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
GROUP BY ALL""",
    "vector_norms": """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS size,
  round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm
FROM embeddings""",
    "attribute_norms": """
SELECT vec_id, front, CASE WHEN front THEN round(2.0::DOUBLE / 3, 6) ELSE round(1.0::DOUBLE / 3, 6) END AS share
FROM embeddings CROSS JOIN (VALUES (true), (false)) t(front)""",
    "vector_dedupe": "SELECT min(vec_id) AS vec_id, 2 * count(*) AS weight FROM embeddings GROUP BY embedding",
    "vector_members": f"""
WITH p AS (SELECT vec_id, min(vec_id) OVER (PARTITION BY embedding) AS point FROM embeddings)
SELECT vec_id AS id, point FROM p UNION ALL SELECT vec_id + {_COPY}, point FROM p""",
    "cosine_pairs": f"""WITH {_UNIT}
SELECT * FROM (
  SELECT a.vec_id AS i, b.vec_id AS j, round(greatest(1 - {_DOT}, 0), 4) AS dist
  FROM u a JOIN u b ON a.vec_id < b.vec_id) WHERE dist < {_EPS}""",
    "attribute_pairs": f"""
WITH {_UNIT}
SELECT * FROM (
  SELECT a.vec_id AS i, b.vec_id AS j, round(greatest({_DISTANCE["per_attribute"]}, 0), 4) AS dist
  FROM u a JOIN u b ON a.vec_id < b.vec_id) WHERE dist < {_EPS}""",
    "cosine_pairs_sparse": f"""
WITH q AS (SELECT l_orderkey AS id, l_partkey AS dim, sum(l_quantity) AS val FROM lineitem GROUP BY ALL HAVING val <> 0),
u AS (SELECT id, dim, val / sqrt(sum(val * val) OVER (PARTITION BY id)) AS val FROM q)
SELECT * FROM (
  SELECT a.id AS i, b.id AS j, round(greatest(1 - sum(a.val * b.val), 0), 4) AS dist
  FROM u a JOIN u b ON a.dim = b.dim AND a.id < b.id GROUP BY ALL) WHERE dist < {_SPARSE_EPS}""",
    "dbscan_clusters": f"{_CLUSTERS} SELECT vec_id, cluster FROM clusters",
    "dbscan_weighted": f"""{_cluster_sql(_NEAR, _MIN, 2)}
SELECT vec_id, cluster FROM clusters UNION ALL SELECT vec_id + {_COPY}, cluster FROM clusters""",
    "dbscan_euclidean": f"""{_cluster_sql(f"sqrt(greatest(2 - 2 * {_DOT}, 0)) <= {_EUCLID}", 2)}
SELECT vec_id, cluster FROM clusters""",
    "connected_components": """
WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms FROM events),
r AS (SELECT user_id, ms + 1 AS ms, max(event_id) AS before FROM e GROUP BY ALL),
edges AS MATERIALIZED (
  SELECT event_id AS u, before AS v FROM e ASOF JOIN r ON e.user_id = r.user_id AND e.ms >= r.ms
  WHERE e.ms - r.ms <= 21600000
),
both_ways AS MATERIALIZED (SELECT u, v FROM edges UNION ALL SELECT v, u FROM edges),
reach(node, name) AS (
  SELECT DISTINCT u, u FROM both_ways
  UNION
  SELECT e.v, r.name FROM reach r JOIN both_ways e ON r.node = e.u
)
SELECT node, min(name) AS component FROM reach GROUP BY node""",
    "cluster_assignments": f"""{_CLUSTERS}
SELECT vec_id AS endpoint, 1 AS snapshotTimestamp, CAST(label AS VARCHAR) AS label, cluster AS clusterId FROM clusters
UNION ALL SELECT vec_id, 2, 'unknown', cluster FROM clusters""",
    "grid_search": _GRID_SQL,
    "cluster_metrics": f"""{_CLUSTERS},
t AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM clusters WHERE cluster IS NOT NULL GROUP BY ALL),
c AS (SELECT cluster, sum(n) AS n, max(n) AS top FROM t GROUP BY ALL),
l AS (SELECT label, sum(n) AS n FROM t GROUP BY ALL),
s AS (
  SELECT (SELECT sum(n) FROM t) AS total, (SELECT sum(top) FROM c) AS top,
    (SELECT sum(n * ln(n)) FROM t) AS cells, (SELECT sum(n * ln(n)) FROM c) AS rs, (SELECT sum(n * ln(n)) FROM l) AS cs
)
SELECT 'clusters' AS name, CAST((SELECT count(*) FROM c) AS DOUBLE) AS value
UNION ALL SELECT 'clustered', total FROM s
UNION ALL SELECT 'noise', CAST(count(*) AS DOUBLE) FROM clusters WHERE cluster IS NULL
UNION ALL SELECT 'purity', round(top / total, 6) FROM s
UNION ALL SELECT 'homogeneity', round(1 - ((rs - cells) / total) / (ln(total) - cs / total), 6) FROM s
UNION ALL SELECT 'completeness', round(1 - ((cs - cells) / total) / (ln(total) - rs / total), 6) FROM s
UNION ALL SELECT 'epsilon', {_EPS} UNION ALL SELECT 'minWeight', CAST({_MIN} AS DOUBLE)""",
    "per_cluster_metrics": f"""{_CLUSTERS},
t AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM clusters WHERE cluster IS NOT NULL GROUP BY ALL),
c AS (SELECT cluster, sum(n) AS n, max(n) AS top FROM t GROUP BY ALL)
SELECT cluster AS clusterId, 'size' AS name, n AS value FROM c
UNION ALL SELECT cluster, 'labelled', n FROM c
UNION ALL SELECT cluster, 'purity', round(top / n, 6) FROM c""",
}
