import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.functions.vectors import as_array, attribute_layout, l2_norm, vector_size
from tidemark.operators import similarity
from tidemark.operators.cluster import dbscan
from tidemark.operators.features import vector_sum
from tidemark.operators.similarity import (
    assign_cells,
    cosine_pairs,
    cosine_radius,
    dedupe_vectors,
    unit_vectors,
    unit_vectors_long,
    vector_members,
)

STRATEGIES = [
    {"cells": "anchors"},
    {"cells": "anchors", "block_rows": 7},
    {"cells": "anchors", "anchors": 6, "block_rows": 5},
    {"cells": "prefix"},
    {"cells": "prefix", "block_rows": 4},
]


def sparse_vectors(n, width, seed, hot=0.4):
    """Sparse vectors of which many share the first dimension; some are zero or copies."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        dims = rnd.sample(range(1, width), rnd.randint(0, 4))
        v = {d: float(rnd.randint(1, 4)) for d in dims}
        if rnd.random() < hot:
            v[0] = float(rnd.randint(1, 9))
        out.append((i, Vectors.sparse(width, v)))
    return out + [(n, out[3][1]), (n + 1, out[5][1])]


def frame(spark, rows):
    return spark.createDataFrame(rows, ["id", "v"])


def global_similarity(a, b):
    x, y = a.toArray(), b.toArray()
    if not x.any() or not y.any():
        return None
    return float(x @ y / math.sqrt(x @ x) / math.sqrt(y @ y))


def attribute_similarity(a, b, layout):
    total = 0.0
    for s in layout:
        x, y = a.toArray()[s.start : s.end], b.toArray()[s.start : s.end]
        if not x.any() and not y.any():
            sim = 1.0
        elif not x.any() or not y.any():
            sim = 0.0
        else:
            sim = x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)
        total += s.weight * sim
    return total / sum(s.weight for s in layout)


def brute_pairs(rows, eps, similarity, faithful=False):
    out = {}
    for n, (i, a) in enumerate(rows):
        for j, b in rows[n + 1 :]:
            sim = similarity(a, b)
            if sim is None or sim == 0:
                continue
            dist = round(max(1 - sim, 0.0), 4)
            if dist < eps and (dist > 0 or not faithful):
                out[min(i, j), max(i, j)] = dist
    return out


def found(df):
    rows = df.collect()
    pairs = {(r["i"], r["j"]): r["dist"] for r in rows}
    assert len(pairs) == len(rows)
    return pairs


@pytest.mark.parametrize("eps", [0.05, 0.265, 0.8])
@pytest.mark.parametrize("options", STRATEGIES)
def test_global_pairs(spark, eps, options):
    rows = sparse_vectors(60, 12, seed=1)
    got = found(cosine_pairs(unit_vectors(frame(spark, rows), "id", "v"), eps, **options))
    assert got == pytest.approx(brute_pairs(rows, eps, global_similarity))
    assert got


@pytest.mark.parametrize("options", STRATEGIES)
def test_attribute_pairs(spark, options):
    rows = sparse_vectors(50, 12, seed=2)
    layout = attribute_layout([("a", 1), ("b", 5), ("c", 6)], {"a": 2.0, "b": 1.0, "c": 0.5})
    assert [(s.start, s.end) for s in layout] == [(0, 1), (1, 6), (6, 12)]
    got = found(cosine_pairs(unit_vectors(frame(spark, rows), "id", "v", layout), 0.3, **options))
    want = brute_pairs(rows, 0.3, lambda a, b: attribute_similarity(a, b, layout))
    assert got == pytest.approx(want)


def test_anchors_prune_and_stay_exact(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16))
    points = [(i, (centres[i % 8] + 0.02 * rng.normal(size=16)).tolist()) for i in range(160)]
    df = spark.createDataFrame(points, "id long, v array<double>")
    vectors = unit_vectors(df, "id", "v")
    placed = assign_cells(vectors.withColumn("weight", F.lit(1)), cosine_radius(0.01), anchors=12)
    copies = placed.agg(F.avg(F.size("cells"))).first()[0]
    assert copies < 3 and placed.where("leader is not null").count() == 0
    rows = [(i, Vectors.dense(v)) for i, v in points]
    got = found(cosine_pairs(vectors, 0.01, anchors=12, block_rows=16))
    assert got == pytest.approx(brute_pairs(rows, 0.01, global_similarity))


def test_faithful_zero_distance_and_bad_eps(spark):
    rows = sparse_vectors(30, 8, seed=4)
    vectors = unit_vectors(frame(spark, rows), "id", "v")
    got = found(cosine_pairs(vectors, 0.2, faithful_zero_distance=True))
    assert got == pytest.approx(brute_pairs(rows, 0.2, global_similarity, faithful=True))
    with pytest.raises(ValueError, match="eps"):
        cosine_pairs(vectors, 1.5)


def test_string_ids_and_empty_input(spark):
    rows = [("b", Vectors.dense(1.0, 2.0)), ("a", Vectors.dense(1.0, 2.1))]
    assert set(found(cosine_pairs(unit_vectors(frame(spark, rows), "id", "v"), 0.1))) == {("a", "b")}
    none = spark.createDataFrame([], "id long, v array<double>")
    for cells in ("anchors", "prefix"):
        assert cosine_pairs(unit_vectors(none, "id", "v"), 0.1, cells=cells).count() == 0


def test_dedupe_and_members(spark, rows):
    data = [(1, Vectors.dense(1.0, 0.0)), (2, Vectors.dense(4.0, 0.0)), (3, Vectors.dense(0.0, 1.0)), (4, Vectors.dense(0.0, 0.0))]
    vectors = unit_vectors(frame(spark, data), "id", "v")
    points = dedupe_vectors(vectors)
    assert rows(points.select("id", "weight")) == [(1, 2), (3, 1), (4, 1)]
    assert rows(vector_members(vectors, points)) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_long_form_equals_vectors(spark, rows):
    data = sparse_vectors(20, 9, seed=5)
    long = [(i, int(d), float(v.toArray()[d])) for i, v in data for d in range(9)]
    by_long = unit_vectors_long(spark.createDataFrame(long, "id long, d int, x double"), "id", "d", "x")
    wide = unit_vectors(frame(spark, data), "id", "v").where(F.size("entries") > 0)
    a, b = ({r["id"]: [tuple(e) for e in r["entries"]] for r in df.collect()} for df in (by_long, wide))
    assert a.keys() == b.keys()
    for i in a:
        assert [d for d, _ in a[i]] == [d for d, _ in b[i]]
        assert [x for _, x in a[i]] == pytest.approx([x for _, x in b[i]])


def test_sums_sizes_and_norms(spark):
    df = spark.createDataFrame(
        [("a", Vectors.sparse(3, {0: 1.0})), ("a", Vectors.sparse(3, {0: 2.0, 2: 4.0})), ("b", Vectors.sparse(3, {}))],
        ["endpoint", "v"],
    )
    sums = {r["endpoint"]: [tuple(e) for e in r["entries"]] for r in vector_sum(df, "endpoint", "v").collect()}
    assert sums == {"a": [(0, 3.0), (2, 4.0)], "b": []}
    dense = df.select("endpoint", vector_to_array("v").alias("v"))
    mixed = spark.createDataFrame([("a", Vectors.dense(3, 0, 4)), ("b", Vectors.dense(0, 0, 0))], ["endpoint", "v"])
    for other in (dense, mixed):
        assert {r["endpoint"]: [tuple(e) for e in r["entries"]] for r in vector_sum(other, "endpoint", "v").collect()} == sums
    sizes = df.select(vector_size(df, "v").alias("n"), l2_norm(as_array(df, "v")).alias("norm")).collect()
    assert [r["n"] for r in sizes] == [3] * 3
    assert sorted(r["norm"] for r in sizes) == pytest.approx([0.0, 1.0, math.sqrt(20)])


def test_no_cross_join_in_the_plan(spark, plan):
    vectors = unit_vectors(frame(spark, sparse_vectors(20, 9, seed=6)), "id", "v")
    for cells in ("anchors", "prefix"):
        text = plan(cosine_pairs(vectors, 0.2, cells=cells))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_few_points_are_many_groups(spark):
    """Even small tables are cut into cells and compared in many tasks."""
    from tidemark.operators.similarity import GROUPS_PER_PARTITION, compare_blocks

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8))
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(scale=0.02, size=8)]) for i in range(500)]
    vectors = unit_vectors(spark.createDataFrame(rows, "vec long, v array<double>"), "vec", "v")
    radius = cosine_radius(0.01)
    placed = assign_cells(vectors, radius).cache()
    cells = placed.selectExpr("explode(cells) AS at").groupBy("at.cell").count().collect()
    assert len(cells) >= 16
    # Tight groups far from each other: next to no point is copied.
    assert sum(r["count"] for r in cells) < 2 * 500
    groups = compare_blocks(placed, lambda b: {"n": np.array([len(b.rows)])}, "n long", radius)
    assert groups.count() >= 16
    assert GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")) >= 16


def test_wide_blocks_stay_small(spark, monkeypatch):
    """The product is summed over slices of the shared dimensions."""
    from tidemark.operators import similarity

    rng = np.random.default_rng(6)
    dims = np.array([np.sort(rng.choice(1_000_000, 40, replace=False)) for _ in range(300)], dtype=object)
    dims[1] = dims[0]
    vals = np.array([np.full(40, 40**-0.5)] * 300, dtype=object)
    cols = {"dims": dims, "vals": vals, "second": np.zeros(300, bool), "earlier": np.array([None] * 300)}
    monkeypatch.setattr(similarity, "MATRIX_VALUES", 3000)
    block = similarity._Block(cols, np.arange(300), diagonal=True)
    assert block.compare(0.1) and list(zip(block.rows, block.cols)) == [(0, 1)]
    assert np.isclose(block.distance[0], 0)


def dense_block(x, keep_vectors):
    """A diagonal block of unit vectors, with or without values beyond the leading ones."""
    from tidemark.operators import similarity

    used = np.arange(x.shape[1])
    _, directions = np.linalg.eigh(x.T @ x)
    head = x @ directions[:, ::-1]
    cols = {"square": (x * x).sum(axis=1), "second": np.zeros(len(x), bool), "earlier": np.array([None] * len(x)), "head": head}
    if keep_vectors:
        cols["head"] = np.ascontiguousarray(head[:, : x.shape[1] // 2])
        cols["dims"] = np.array([used] * len(x) + [None], dtype=object)[:-1]
        cols["vals"] = np.array([*x, None], dtype=object)[:-1]
    return similarity._Block(cols, np.arange(len(x)), diagonal=True)


@pytest.mark.parametrize("keep_vectors", [False, True])
def test_leading_values_tell_most_pairs_apart(keep_vectors):
    """Even vectors without any structure need less than half of all values at the radii of the grid."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 64))
    x[:40] = x[40:80] + 0.02 * rng.normal(size=(40, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T
    for eps in (0.015, 0.065, 0.115, 0.165):
        block = dense_block(x, keep_vectors)
        assert block.compare(cosine_radius(eps))
        i, j = np.nonzero(np.triu(near >= 1 - cosine_radius(eps), 1))
        assert sorted(zip(block.rows, block.cols)) == sorted(zip(i, j))
        assert block.distance == pytest.approx(1 - near[block.rows, block.cols])
        assert block.multiplied < 0.5 * len(x) ** 2 * 64
    block = dense_block(x, keep_vectors)
    assert block.compare(1.0) and len(block.rows) == (near[np.triu_indices(len(x), 1)] >= 0).sum()


def test_wide_vectors_have_more_than_leading_values(spark, monkeypatch):
    """Dimensions and directions beyond those fitted are part of the length that is left."""
    from tidemark.operators import similarity

    monkeypatch.setattr(similarity, "FIT_DIMS", 20)
    monkeypatch.setattr(similarity, "HEAD", 5)
    rng = np.random.default_rng(9)
    rows = [(i, Vectors.dense(*rng.normal(size=40).tolist())) for i in range(60)]
    rows += [(100 + i, Vectors.dense(*(v.toArray() + 0.05 * rng.normal(size=40)).tolist())) for i, v in rows[:20]]
    vectors = unit_vectors(frame(spark, rows), "id", "v")
    assert "entries" in assign_cells(vectors, cosine_radius(0.1), anchors=9).columns
    for eps in (0.01, 0.7):
        got = found(cosine_pairs(vectors, eps, anchors=9, block_rows=11))
        assert got == pytest.approx(brute_pairs(rows, eps, global_similarity))


def test_open_cells_are_merged_to_a_fixed_number():
    """Where every point visits every earlier cell, the number of cells does not grow with the points."""
    for count in (30, 300, 3000):
        rows, none = np.full(count, 1000), np.zeros(count, bool)
        most = (rows * np.arange(count)).sum()
        merged = similarity._merged(rows, none, most)
        assert merged[-1] + 1 <= similarity.MERGED_CELLS and (np.diff(merged) >= 0).all()
        assert np.bincount(merged).max() <= 1000 * (count // similarity.MERGED_CELLS + 1)
        # Where bounds hold, cells stay as they are.
        assert list(similarity._merged(rows, none, most // 3)) == list(range(count))
    ball = none.copy()
    ball[[5, 6, 40]] = True
    merged = similarity._merged(rows, ball, most)
    assert all((merged == merged[n]).sum() == 1 for n in (5, 6, 40))


def test_few_uneven_cells_are_merged_to_as_many_as_many_even_ones():
    few = np.array([471, 909, 646, 539, 650, 1357, 909, 1266, 646, 480, 590, 641, 700, 520, 610, 520])
    many = np.random.default_rng(1).integers(800, 1700, 600)
    for rows in (few, many):
        merged = similarity._merged(rows, np.zeros(len(rows), bool), (rows * np.arange(len(rows))).sum())
        assert merged[0] == 0 and set(np.diff(merged)) <= {0, 1}
        assert merged[-1] + 1 == similarity.MERGED_CELLS


def test_copies_of_a_point_do_not_grow_with_the_points(spark):
    """Vectors without any structure, of which each could be near each; groups count their rows and compare nothing."""

    class RowsOfGroup:
        def __init__(self, cols):
            self.rows = len(cols["id"])

        def needed(self, block):
            return []

        def overflow(self):
            return []

        def rest(self):
            return [{"rows": np.array([self.rows])}]

    copies = []
    for count in (11_000, 44_000):
        x = np.random.default_rng(count).normal(size=(count, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        entry = pa.StructArray.from_arrays([pa.array(np.tile(np.arange(64, dtype="int32"), count)), pa.array(x.ravel())], ["dim", "val"])
        entries = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, 64, dtype="int32")), entry)
        points = spark.createDataFrame(pa.table({"id": np.arange(count), "entries": entries}))
        radius = cosine_radius(0.65)
        placed = assign_cells(points, radius)
        sent = similarity.compare_blocks(placed, RowsOfGroup, "rows bigint", radius, gather=True)
        copies.append(sent.agg(F.sum("rows")).first()[0] / count)
    assert max(copies) < similarity.MERGED_CELLS and copies[1] < 1.1 * copies[0], copies


def test_tiles_have_every_pair_once(monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 7)
    second = np.arange(50) >= 20
    for diagonal in (True, False):
        pairs = []
        for tile in similarity._Block({"second": second}, np.arange(50), diagonal).tiles():
            left, right = tile._sides[0], tile._sides[-1]
            assert max(len(left), len(right)) <= 7
            pairs += [(i, j) for i in left for j in right if not tile.diagonal or i < j]
        want = [(i, j) for i in range(50) for j in range(50) if (i < j if diagonal else i < 20 <= j)]
        assert sorted(pairs) == want


def test_merged_cells_have_the_same_pairs_and_clusters(spark, rows, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12))
    x[:40] = x[0] + rng.normal(size=(40, 12)) / 1000
    x /= np.linalg.norm(x, axis=1)[:, None]
    data = [(n, [(d, float(v)) for d, v in enumerate(row)], 1) for n, row in enumerate(x)]
    points = spark.createDataFrame(data, "id long, entries array<struct<dim:int,val:double>>, weight long")
    dist = np.round(np.maximum(1 - x @ x.T, 0), 4)
    want = sorted((i, j) for i in range(300) for j in range(i + 1, 300) if dist[i, j] < 0.4)
    got, kept = [], similarity._merged
    for merged in (True, False):
        groups = []
        monkeypatch.setattr(similarity, "_merged", lambda *a: groups.append(kept(*a) if merged else np.arange(len(a[0]), dtype="int32")) or groups[-1])
        monkeypatch.setattr(similarity, "MERGED_CELLS", 4)
        pairs = similarity.cosine_pairs(points, 0.4, anchors=20).collect()
        assert sorted((r["i"], r["j"]) for r in pairs) == want
        got.append(rows(dbscan(points, [0.01, 0.4], 3, anchors=20)))
        assert all((g[-1] + 1 < len(g)) == merged for g in groups)
    assert got[0] == got[1]


def test_single_precision_decides_nothing(monkeypatch):
    """Pairs next to the radius are told by double precision, in strips and with many pairs left."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 64))
    x[:60] = x[0] + rng.normal(size=(60, 64)) / 50
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    monkeypatch.setattr(similarity, "_STRIP", 37)
    near = x @ x.T
    for least in (*np.sort(near[0, 1:60])[::7], *np.sort(near[np.triu_indices(300, 1)])[-5000::617]):
        for step in (-1e-12, 1e-12):
            block = dense_block(x, False)
            assert block.compare(1 - least + step)
            i, j = np.nonzero(np.triu(near >= least - step - 1e-9, 1))
            assert sorted(zip(block.rows, block.cols)) == sorted(zip(i, j))
    block = similarity._Block(block._cols, np.arange(300), diagonal=True)
    left = [pair for part in block.without(np.arange(300) < 200) for pair in pairs_of(part)]
    assert sorted(left) == [(i, j) for i in range(300) for j in range(i + 1, 300) if j >= 200]


def pairs_of(block):
    left, right = block._sides[0], block._sides[-1]
    return [(min(i, j), max(i, j)) for i in left for j in right if not block.diagonal or i < j]


def test_vectors_are_matched_by_hash_first(spark, rows):
    data = [(n, [(0, float(n % 3)), (1, 1.0)]) for n in range(9)] + [(9, None)]
    vectors = spark.createDataFrame(data, "id long, entries array<struct<dim:int,val:double>>")
    found = vector_members(vectors, dedupe_vectors(vectors))
    assert rows(found) == [(n, n % 3) for n in range(9)]
    assert "hash" in found._jdf.queryExecution().optimizedPlan().toString()


def test_members_of_points_that_agree_in_their_hash(spark, rows):
    """Points of one hash are told apart by their entries; null entries are no point's."""
    schema = "id long, entries array<struct<dim:int,val:double>>"
    vectors = spark.createDataFrame([(1, [(0, 1.0)]), (2, [(0, 1.0)]), (3, [(1, 1.0)]), (None, [(1, 1.0)]), (4, None), (5, [(2, 1.0)])], schema)
    points = spark.createDataFrame([(1, [(0, 1.0)]), (7, [(0, 1.0)]), (3, [(1, 1.0)]), (4, None)], schema)
    assert rows(vector_members(vectors, points)) == sorted([(1, 1), (1, 7), (2, 1), (2, 7), (3, 3), (None, 3)], key=repr)


def test_prefix_cells_take_no_shuffle_of_vectors(spark, plan):
    """Dimensions of one vector are no cell, rare dimensions come first, and points stay where they are."""
    data = [(1, {0: 1.0, 1: 1.0, 2: 1.0}), (2, {0: 1.0, 1: 1.0}), (3, {0: 3.0, 4: 4.0}), (4, {5: 1.0}), (None, {0: 1.0})]
    rows = spark.createDataFrame([(i, Vectors.sparse(6, v)) for i, v in data], ["id", "v"])
    vectors = unit_vectors(rows, "id", "v")
    placed = assign_cells(vectors, 0.95, cells="prefix")
    assert {r["id"]: r["prefix"] for r in placed.collect()} == {1: [1, 0], 2: [1, 0], 3: [0]}
    assert [[c["cell"] for c in r["cells"]] == r["prefix"] for r in placed.collect()] == [True] * 3
    assert "Exchange" not in plan(similarity._prefix_cells(vectors, 0.95))


def test_small_cells_are_looked_up_together(spark, monkeypatch):
    """Few rows at a time, small and large cells, short and long vectors: the same pairs, each once."""
    data = sparse_vectors(80, 12, seed=11)
    vectors = unit_vectors(frame(spark, data), "id", "v").where(F.size("entries") > 0).collect()
    dims = np.array([np.array([e["dim"] for e in r["entries"]]) for r in vectors] + [None], dtype=object)[:-1]
    vals = np.array([np.array([e["val"] for e in r["entries"]]) for r in vectors] + [None], dtype=object)[:-1]
    n = len(vectors)
    earlier = np.array([d[:1] if len(d) > 2 else d[:0] for d in dims] + [None], dtype=object)[:-1]
    cols = {"dims": dims, "vals": vals, "second": np.zeros(n, bool), "earlier": earlier}
    edges, small = np.array([0, 30, 31, 50, n]), np.array([True, True, False, True])
    monkeypatch.setattr(similarity, "_LOOKUPS", 37)
    got = []
    lists = {c: similarity._ragged(pa.chunked_array([pa.array(list(cols[c]))])) for c in ("dims", "vals", "earlier")}
    for block in similarity._small_cells(cols, lists, edges, small, 0.5):
        got += zip(*block.numbers(), block.distance.round(9))
    want = []
    for begin, end in ((0, 30), (50, n)):
        block = similarity._Block(cols, np.arange(begin, end), diagonal=True)
        assert block.compare(0.5)
        want += zip(*block.numbers(), block.distance.round(9))
    assert np.allclose(sorted(got), sorted(want)) and len(set(got)) == len(got) == len(want) > 0
    monkeypatch.setattr(similarity, "_SHORT", 2)
    assert list(similarity._is_small(np.array([1, 2, 3, 1, 1]), np.array([0, 2, 3, 5]))) == [True, False, True]
