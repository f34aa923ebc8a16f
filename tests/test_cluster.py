import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.functions.vectors import attribute_layout
from tidemark.operators import cluster, similarity
from tidemark.operators.cluster import _ball_radius, _Links, connected_components, dbscan
from tidemark.operators.metrics import (
    cluster_quality,
    latest_known_labels,
    merge_metrics,
    pivot_metrics,
)
from tidemark.operators.similarity import assign_cells, cosine_radius, dedupe_vectors, unit_vectors
from tidemark.plans import groups
from tidemark.plans.groups import ClusterParams, cluster_endpoints, grid_search

OPTIONS = [{}, {"block_rows": 6}, {"anchors": 5, "block_rows": 9}, {"cells": "prefix"}]


def points_of(n, seed, dims=3):
    rng = np.random.default_rng(seed)
    return [(i, np.abs(rng.normal(size=dims)).round(3).tolist()) for i in range(n)]


def brute(points, weights, near, min_weight):
    """Cluster of each point by union-find over core points."""
    n = len(points)
    adjacent = [[j for j in range(n) if j != i and near(points[i], points[j])] for i in range(n)]
    core = [weights[i] + sum(weights[j] for j in adjacent[i]) >= min_weight for i in range(n)]
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in adjacent[i]:
            if core[i] and core[j]:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    out = {}
    for i in range(n):
        if core[i]:
            out[i] = top(i)
        else:
            out[i] = min((top(j) for j in adjacent[i] if core[j]), default=None)
    return out, core


def cosine_near(eps, faithful=False):
    def near(a, b):
        x, y = np.array(a), np.array(b)
        dist = round(max(1 - float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 0), 4)
        return dist < eps and (dist > 0 or not faithful)

    return near


def frame(spark, points):
    return unit_vectors(spark.createDataFrame(points, "id long, v array<double>"), "id", "v")


@pytest.mark.parametrize("options", OPTIONS)
def test_against_brute_force(spark, options):
    points = points_of(70, seed=1)
    weights = [1 + i % 3 for i in range(70)]
    weighted = frame(spark, points).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("id").cast("int") + 1))
    eps_values = [0.002, 0.01, 0.03]
    got = dbscan(weighted, eps_values, 5, **options).collect()
    for eps in eps_values:
        want, core = brute([p for _, p in points], weights, cosine_near(eps), 5)
        rows = [r for r in got if r["eps"] == eps]
        assert len(rows) == 70
        assert {r["id"]: r["cluster"] for r in rows} == want
        assert [r["core"] for r in sorted(rows, key=lambda r: r["id"])] == core


def test_sparse_vectors_are_sent_in_turns(spark, monkeypatch):
    """Some rows at a time, small and large cells: the same clusters."""
    points = points_of(60, seed=4, dims=5)
    vectors = frame(spark, points).withColumn("weight", F.lit(1))
    want, _ = brute([p for _, p in points], [1] * 60, cosine_near(0.05), 3)
    sent = []
    compare = cluster.compare_blocks
    monkeypatch.setattr(cluster, "compare_blocks", lambda *args, turn, **options: (sent.append(turn), compare(*args, turn=turn, **options))[1])
    monkeypatch.setattr(similarity, "TURN_ROWS", 100)
    for block_rows in (None, 11):
        got = dbscan(vectors, 0.05, 3, cells="prefix", block_rows=block_rows).collect()
        assert {r["id"]: r["cluster"] for r in got} == want
    assert sent == [(0, 2), (1, 2)] * 2


def test_euclidean_and_faithful(spark):
    points = points_of(50, seed=2)
    vectors = frame(spark, points).withColumn("weight", F.lit(1))

    def near(a, b):
        x, y = np.array(a) / np.linalg.norm(a), np.array(b) / np.linalg.norm(b)
        return float(np.linalg.norm(x - y)) <= 0.15

    want, _ = brute([p for _, p in points], [1] * 50, near, 3)
    got = dbscan(vectors, 0.15, 3, metric="euclidean").collect()
    assert {r["id"]: r["cluster"] for r in got} == want

    near_copies = points + [(50, [x * 1.00001 for x in points[0][1]]), (51, [x * 3 for x in points[0][1]])]
    want, _ = brute([p for _, p in near_copies], [1] * 52, cosine_near(0.01, faithful=True), 3)
    got = dbscan(frame(spark, near_copies).withColumn("weight", F.lit(1)), 0.01, 3, faithful_zero_distance=True)
    assert {r["id"]: r["cluster"] for r in got.collect()} == want


def test_copies_make_a_core_and_zero_vectors_stay_alone(spark):
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [0.0, 0.0])]
    vectors = frame(spark, data)
    points = dedupe_vectors(vectors)
    got = {r["id"]: (r["cluster"], r["core"]) for r in dbscan(points, 0.1, 2).collect()}
    assert got == {1: (1, True), 3: (None, False), 4: (4, True)}


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_dense_balls_are_not_compared_and_stay_exact(spark, metric):
    rng = np.random.default_rng(7)
    centres = np.abs(rng.normal(size=(5, 4)))
    sizes = [60, 25, 12, 3, 1]
    points = [
        (centres[c] + rng.normal(size=4) * rng.choice([0.002, 0.05])).tolist()
        for c, size in enumerate(sizes) for _ in range(size)
    ]
    points = list(enumerate(points))
    vectors = frame(spark, points).withColumn("weight", F.lit(1).cast("long"))
    eps_values = [0.06, 0.1] if metric == "euclidean" else [0.002, 0.005]

    def euclidean_near(eps):
        def near(a, b):
            x, y = np.array(a) / np.linalg.norm(a), np.array(b) / np.linalg.norm(b)
            return float(np.linalg.norm(x - y)) <= eps

        return near

    near_of = euclidean_near if metric == "euclidean" else cosine_near
    got = dbscan(vectors, eps_values, 6, metric=metric, anchors=30, block_rows=8).collect()
    for eps in eps_values:
        want, core = brute([p for _, p in points], [1] * len(points), near_of(eps), 6)
        rows = sorted((r for r in got if r["eps"] == eps), key=lambda r: r["id"])
        assert [r["core"] for r in rows] == core
        assert {r["id"]: r["cluster"] for r in rows} == want

    reach = _ball_radius(metric, eps_values[0])
    placed = assign_cells(vectors, cosine_radius(0.005), anchors=30, dense=(reach, 6))
    assert placed.where("leader is not null").count() >= 40


def test_invariant_to_renaming(spark):
    points = points_of(60, seed=3)
    names = random.Random(4).sample(range(1000), 60)
    renamed = [(names[i], v) for i, v in points]
    one, two = (
        {r["id"]: r["cluster"] for r in dbscan(frame(spark, p).withColumn("weight", F.lit(1)), 0.01, 2).collect()}
        for p in (points, renamed)
    )
    groups = lambda m, back: {
        frozenset(back(i) for i in m if m[i] == c) for c in set(m.values()) if c is not None
    }
    # With min_weight 2 every point with a neighbour is core, so no border is ambiguous.
    assert groups(one, lambda i: names[i]) == groups(two, lambda i: i)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    chain = [(0, i, i + 1) for i in range(40)]
    star = [(1, 100, i) for i in range(40)]
    noise = [(2, rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    edges = chain + star + noise
    rnd.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "g int, u long, v long"), by=["g"]).collect()
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for g, u, v in edges:
        if u != v:
            a, b = sorted((top((g, u)), top((g, v))))
            root[b] = a
    assert {(r["g"], r["node"]): r["component"] for r in got} == {x: top(x)[1] for x in root}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    lonely = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]).withColumn("weight", F.lit(1))
    assert [r["cluster"] for r in dbscan(lonely, 0.1, 2).collect()] == [None, None]


def snapshots(spark):
    rows = []
    for i in range(24):
        kind = i % 3
        v = {kind: 1.0, 3: 0.1 + 0.001 * i}
        rows.append((f"e{i}", 1, Vectors.sparse(4, v), "tv" if kind == 0 else "cam"))
        rows.append((f"e{i}", 2, Vectors.sparse(4, {kind: 1.0}), "unknown" if i % 2 else ("tv" if kind == 0 else "cam")))
    rows.append(("odd", 1, Vectors.sparse(4, {3: 1.0}), "phone"))
    return spark.createDataFrame(rows, ["endpoint", "snapshotTimestamp", "sparseFeatures", "label"])


def test_cluster_pipeline(spark):
    found = cluster_endpoints(snapshots(spark), ClusterParams(eps=0.1, min_weight=3), label="label")
    clusters = {r["endpoint"]: r["clusterId"] for r in found.endpoints.collect()}
    assert len(clusters) == 25 and clusters["odd"] is None
    assert {clusters["e0"], clusters["e1"], clusters["e2"]} == {"e0", "e1", "e11"}
    assert found.snapshots.count() == 49
    metrics = {r["name"]: r["value"] for r in found.metrics.collect()}
    assert metrics["clusters"] == 3 and metrics["noise"] == 1 and metrics["purity"] == 1
    assert metrics["homogeneity"] == pytest.approx(1) and 0 < metrics["completeness"] < 1
    assert metrics["epsilon"] == 0.1 and metrics["minWeight"] == 3
    sizes = {r["clusterId"]: r["value"] for r in found.per_cluster.where("name = 'size'").collect()}
    assert sizes == {"e0": 8, "e1": 8, "e11": 8}


def test_cluster_parameters_are_checked(spark):
    for params in (
        ClusterParams(distance="other"),
        ClusterParams(distance="per_attribute"),
        ClusterParams(distance="per_attribute", euclidean=True, layout=attribute_layout([("a", 4)], {"a": 1.0})),
    ):
        with pytest.raises(ValueError):
            cluster_endpoints(snapshots(spark), params)


def test_grid_search_equals_single_runs(spark):
    layout = attribute_layout([("kind", 3), ("rest", 1)], {"kind": 1.0, "rest": 1.0})
    df = snapshots(spark)
    best, metrics = grid_search(df, "label", layout, min_weight=3, eps_grid=(0.001, 0.1), metric="purity")
    wide = {r["param"]: r.asDict() for r in metrics.collect()}
    assert len(wide) == 4
    for eps in (0.001, 0.1):
        for distance in ("global", "per_attribute"):
            params = ClusterParams(eps=eps, min_weight=3, distance=distance, layout=layout)
            single = {r["name"]: r["value"] for r in cluster_endpoints(df, params, label="label").metrics.collect()}
            row = {k: v for k, v in wide[f"eps={eps},min_weight=3,distance={distance}"].items() if v is not None}
            assert {k: row[k] for k in single} == pytest.approx(single)
    # Equal scores are decided by the order of the grid.
    assert (best.eps, best.distance) == (0.001, "global")


def test_grid_search_without_scores_gives_the_default(spark):
    none = snapshots(spark).withColumn("label", F.lit("unknown"))
    best, _ = grid_search(none, "label", (), min_weight=3, eps_grid=(0.1,), distances=("global",), metric="purity")
    assert best == ClusterParams(min_weight=3, layout=())


def test_latest_known_label(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "unknown"), ("b", 1, None), ("c", 1, "p"), ("c", 1, "q")],
        "endpoint string, snapshotTimestamp int, label string",
    )
    assert rows(latest_known_labels(df, "label")) == [("a", "y"), ("c", "q")]


def test_metric_tables(spark, rows):
    long = spark.createDataFrame([("p1", "a", 1.0), ("p1", "b", 2.0), ("p2", "a", 3.0)], "param string, name string, value double")
    assert rows(pivot_metrics(long, "param", ["a", "b"])) == [("p1", 1.0, 2.0), ("p2", 3.0, None)]
    left = spark.createDataFrame([("x", 1), ("y", 2)], "label string, n int")
    right = spark.createDataFrame([("y", 3), ("z", 4)], "label string, m int")
    assert rows(merge_metrics(left, right)) == sorted([("x", 1, None), ("y", 2, 3), ("z", None, 4)], key=repr)


def test_quality_without_labels(spark):
    assigned = spark.createDataFrame([("a", 1), ("b", 1), ("c", None)], "endpoint string, clusterId int")
    none = spark.createDataFrame([], "endpoint string, label string")
    metrics, per = cluster_quality(assigned, none)
    assert {r["name"]: r["value"] for r in metrics.collect()} == {"clusters": 1, "clustered": 2, "noise": 1}
    assert {r["name"]: r["value"] for r in per.collect()} == {"size": 2, "labelled": 0}


def test_rows_of_a_group_do_not_grow_with_its_blocks(monkeypatch):
    """One row per point and eps, and fewer links of a point than make it core."""
    n, least = 400, 4
    x = np.random.default_rng(4).normal(size=(n, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cols = {"id": np.arange(n), "weight": np.ones(n, "int64"), "ball": np.array([None] * n), "square": np.ones(n),
            "head": x, "second": np.zeros(n, bool), "earlier": np.array([None] * n)}
    eps_values = [0.05, 0.4]
    for block_rows in (400, 20):
        monkeypatch.setattr(similarity, "BLOCK_ROWS", block_rows)
        links = _Links(cols, similarity._nearness("cosine", eps_values, False), 2, least)
        for tile in similarity._Block(cols, np.arange(n), True).tiles():
            for block in links.needed(tile):
                if block.compare(cosine_radius(0.4)):
                    links.add(block)
        out = links.rest()
        rows = sum(len(part["id"]) for part in out)
        assert rows <= 2 * n + 2 * n * (least - 1)
        dist = np.round(np.maximum(1 - x @ x.T, 0), 4)
        near = [(dist < eps) & ~np.eye(n, dtype=bool) for eps in eps_values]
        for k, part in enumerate(out[2:]):
            assert dict(zip(part["id"], part["seen"])) == {i: c for i, c in enumerate(near[k].sum(axis=1)) if c}


def test_core_points_of_one_cluster_are_not_compared_again(monkeypatch):
    n = 300
    x = np.ones((n, 3)) + np.random.default_rng(4).normal(size=(n, 3)) / 100
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cols = {"id": np.arange(n), "weight": np.ones(n, "int64"), "ball": np.array([None] * n), "square": np.ones(n),
            "head": x, "second": np.zeros(n, bool), "earlier": np.array([None] * n)}
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 20)
    monkeypatch.setattr(cluster, "_TAKEN", 100)
    links, compared = _Links(cols, similarity._nearness("cosine", [0.1], False), 1, 3), 0
    for tile in similarity._Block(cols, np.arange(n), True).tiles():
        for block in links.needed(tile):
            compared += len(block._sides[0]) * len(block._sides[-1])
            if block.compare(cosine_radius(0.1)):
                links.add(block)
    (single, met) = links.rest()
    assert compared < 20 * 2 * n and not len(single["id"])
    assert met["sure"].all() and set(met["other"]) == {0} and len(met["id"]) == n


def test_a_small_block_of_the_grid_has_the_same_clusters(spark, monkeypatch):
    points = points_of(90, seed=8)
    monkeypatch.setattr(cluster, "_TAKEN", 5)
    monkeypatch.setattr(cluster, "MATRIX_VALUES", 20)
    got = dbscan(frame(spark, points).withColumn("weight", F.lit(1)), [0.002, 0.02], 6, anchors=4, block_rows=7).collect()
    for eps in (0.002, 0.02):
        want, _ = brute([p for _, p in points], [1] * 90, cosine_near(eps), 6)
        assert {r["id"]: r["cluster"] for r in got if r["eps"] == eps} == want


def test_clusters_of_the_grid_are_found_once(spark, monkeypatch):
    df = spark.createDataFrame([(str(i), 1, Vectors.dense(1.0, i % 3), "a") for i in range(9)], ["endpoint", "snapshotTimestamp", "sparseFeatures", "label"])
    plans = []

    def quality(assignments, *args, **options):
        plans.append(assignments._jdf.queryExecution().optimizedPlan().toString())
        return cluster_quality(assignments, *args, **options)

    monkeypatch.setattr(groups, "cluster_quality", quality)
    grid_search(df, "label", (), min_weight=3, eps_grid=(0.1,), distances=("global",), metric="purity")
    assert len(plans) == 1 and "Join" not in plans[0]


def test_small_balls_do_not_make_more_cells(spark, monkeypatch):
    """Where cells are merged, only balls as large as a merged cell stay apart; all keep their leaders."""
    monkeypatch.setattr(similarity, "MERGED_CELLS", 4)
    monkeypatch.setattr(similarity, "_OPEN", 0.0)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 12)).repeat(3, axis=0) + rng.normal(size=(90, 12)) / 1000
    big = rng.normal(size=12) + rng.normal(size=(50, 12)) / 1000
    for rows, apart in ((x, 0), (np.concatenate([x, big]), 1)):
        points = [(i, row.tolist()) for i, row in enumerate(rows)]
        vectors = frame(spark, points).withColumn("weight", F.lit(1).cast("long"))
        placed = assign_cells(vectors, cosine_radius(0.65), anchors=30, dense=(_ball_radius("cosine", 0.65), 3))
        roles = placed.select("leader", F.explode("cells").alias("at"))
        assert roles.select("at.cell").distinct().count() <= 4 + 2 * apart
        assert placed.where("leader is not null").count() > len(rows) / 4
        inner = roles.where(f"at.role = {similarity._INNER}")
        assert inner.select("at.cell").distinct().count() == apart
        assert inner.count() >= 50 * apart
        got = dbscan(vectors, [0.3, 0.65], 3, anchors=30, block_rows=20).collect()
        for eps in (0.3, 0.65):
            want, core = brute([p for _, p in points], [1] * len(points), cosine_near(eps), 3)
            found = sorted((r for r in got if r["eps"] == eps), key=lambda r: r["id"])
            assert {r["id"]: r["cluster"] for r in found} == want
            assert [r["core"] for r in found] == core
