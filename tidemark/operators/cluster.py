"""Weighted density clusters from cosine neighbours.

The neighbour graph is never written out. One pass over the groups of blocks returns
each point's neighbour weights, and of the points that are core by the neighbours met
in a group, only which hang together there. Links of other points are returned one by
one; a point has fewer of these in a group than the weight that makes it core. Several
eps values share the pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import similarity
from tidemark.operators.similarity import (
    MATRIX_VALUES,
    ROUNDING,
    _Block,
    _nearness,
    assign_cells,
    compare_blocks,
    cosine_radius,
    euclidean_radius,
    vector_members,
)
from tidemark.session import cut_lineage, splittable, stored

# Pairs that are taken in before neighbour weights and links are brought up to date.
_TAKEN = 32_768


def dbscan(
    points: DataFrame,
    eps: float | Sequence[float],
    min_weight: int,
    *,
    metric: str = "cosine",
    cells: str = "anchors",
    faithful_zero_distance: bool = False,
    block_rows: int | None = None,
    anchors: int | None = None,
    kept: bool = False,
) -> DataFrame:
    """``(eps, id, cluster, core)`` for ``(id, entries, weight)`` points, which are written unless they are ``kept`` already.

    A point is core if its own weight and those of its neighbours reach
    ``min_weight``. A cluster is a connected set of core points, named after its
    least core id; a border point joins the least-named cluster next to it;
    noise has a null cluster.
    """
    eps_values = sorted({float(e) for e in ([eps] if np.isscalar(eps) else eps)})
    if metric not in ("cosine", "euclidean"):
        raise ValueError("metric must be 'cosine' or 'euclidean'")
    radius = (euclidean_radius if metric == "euclidean" else cosine_radius)(max(eps_values))
    id_type = points.schema["id"].dataType.simpleString()
    near = _nearness(metric, eps_values, faithful_zero_distance)

    points = points.select("id", "entries", F.col("weight").cast("long").alias("weight"))
    if not kept:
        points = stored(points, "points")
    reach = _ball_radius(metric, eps_values[0])
    dense = None if faithful_zero_distance or reach <= 0 else (reach, min_weight)
    placed = assign_cells(points, radius, cells=cells, anchors=anchors, dense=dense)
    # Sparse vectors are sent in turns, so that what is on disk at a time is bounded.
    rows = 0 if "head" in placed.columns else placed.agg(F.sum(F.size("cells"))).first()[0] or 0
    turns = max(1, -(-rows // similarity.TURN_ROWS))
    parts = [
        cut_lineage(compare_blocks(
            placed.withColumn("ball", F.col("leader")),
            lambda cols: _Links(cols, near, len(eps_values), min_weight),
            f"k int, id {id_type}, other {id_type}, seen bigint, sure boolean",
            radius,
            block_rows,
            gather=True,
            turn=(turn, turns),
        ))
        for turn in range(turns)
    ]
    found = reduce(DataFrame.unionByName, parts).where(F.col("id").isNotNull())
    # Points of a dense ball are core at every eps, as they are near each other.
    every = F.explode(F.sequence(F.lit(0), F.lit(len(eps_values) - 1))).alias("k")
    inner = placed.where(F.col("leader").isNotNull())
    enough = inner.select(every, "id", F.lit(min_weight).cast("long").alias("seen"))
    sums = [F.coalesce(F.sum(F.when(F.col("k") == k, F.col("seen"))), F.lit(0)) for k in range(len(eps_values))]
    totals = found.where("seen > 0").select("k", "id", "seen").unionByName(enough).groupBy("id").agg(
        F.array(*sums).alias("counts")
    )
    alone = F.array(*[F.lit(0).cast("long")] * len(eps_values))
    core = F.transform(
        F.coalesce("counts", alone), lambda c: c + F.col("weight") >= F.lit(min_weight)
    )
    cores = cut_lineage(points.join(totals, "id", "left").select("id", core.alias("core")))

    # Links of points that were not surely core in their group, now that all weights are known.
    known = cores.groupBy("id").agg(F.array(*[F.max(F.col("core")[k]) for k in range(len(eps_values))]).alias("core"))
    single = (
        found.where("seen = 0").select("k", "id", "other")
        .join(known.withColumnRenamed("core", "one"), "id")
        .join(known.select(F.col("id").alias("other"), F.col("core").alias("two")), "other")
        .select("k", "id", "other", F.col("one")[F.col("k")].alias("one"), F.col("two")[F.col("k")].alias("two"))
        .where("one or two")
    )
    single = cut_lineage(single)
    balls = inner.select(every, F.col("id").alias("u"), F.col("leader").alias("v"))
    edges = balls.unionByName(
        found.where("sure").select("k", F.col("id").alias("u"), F.col("other").alias("v"))
    ).unionByName(single.where("one and two").select("k", F.col("id").alias("u"), F.col("other").alias("v")))
    component = _components(edges, ["k"])

    flags = cores.select("id", F.posexplode("core").alias("k", "core"))
    named = (
        flags.where("core")
        .join(component.select("k", F.col("node").alias("id"), "component"), ["k", "id"], "left")
        .select("k", "id", F.coalesce("component", "id").alias("cluster"))
    )
    ends = ["if(one, other, id) id", "if(one, id, other) root"]
    border = (
        single.where("not (one and two)").selectExpr("k", *ends)
        .join(splittable(named.select("k", F.col("id").alias("root"), "cluster")), ["k", "root"])
        .groupBy("k", "id")
        .agg(F.min("cluster").alias("cluster"))
    )
    eps_of = F.element_at(F.array(*[F.lit(e) for e in eps_values]), F.col("k") + 1)
    return flags.join(named.unionByName(border), ["k", "id"], "left").select(
        eps_of.alias("eps"), "id", "cluster", "core"
    )


def connected_components(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, node, component)`` for undirected edges ``(*by, u, v)``.

    Alternates large-star and small-star steps (Kiveris et al., SoCC 2014) until
    every other node points at the least node of its component and at nothing else;
    each round is written to the checkpoint folder.
    """
    by = list(by)
    return _components(cut_lineage(edges.select(*by, "u", "v").distinct()), by)


def _components(stored: DataFrame, by: list[str]) -> DataFrame:
    current = stored.where("u <> v").select(
        *by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()
    while not _is_star_forest(current, by):
        current = cut_lineage(_small_star(_large_star(current, by), by))
    roots = current.select(*by, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(*by, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _ball_radius(metric: str, eps: float) -> float:
    """Euclidean distance from a centre within which points are surely neighbours."""
    if metric == "euclidean":
        return eps / 2 - 1e-6
    return float(np.sqrt(max(0.0, 2.0 * (eps - ROUNDING)))) / 2 - 1e-6


def expand_clusters(
    clusters: DataFrame, vectors: DataFrame, points: DataFrame, id_col: str = "endpoint"
) -> DataFrame:
    """Carry point clusters to every member: ``(eps, id_col, clusterId)``."""
    labelled = clusters.select("eps", F.col("id").alias("point"), "cluster")
    # Vectors are sent once, not once per eps.
    return vector_members(vectors, points).join(splittable(labelled), "point").select(
        "eps", F.col("id").alias(id_col), F.col("cluster").alias("clusterId")
    )


def _is_star_forest(edges: DataFrame, by: list[str]) -> bool:
    one, none = F.lit(1).alias("below"), F.lit(0).alias("below")
    ends = edges.select(*by, F.col("u").alias("node"), one).unionByName(
        edges.select(*by, F.col("v").alias("node"), none)
    )
    uses = ends.groupBy(*by, "node").agg(
        F.sum("below").alias("below"), F.min("below").alias("least")
    )
    return uses.where("below > 1 or (below = 1 and least = 0)").isEmpty()


def _large_star(edges: DataFrame, by: list[str]) -> DataFrame:
    """Point every child at the least parent of its parent (a root keeps its children)."""
    least = edges.groupBy(*by, F.col("u").alias("v")).agg(F.min("v").alias("m"))
    moved = edges.join(splittable(least), [*by, "v"], "left")
    return moved.select(*by, "u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame, by: list[str]) -> DataFrame:
    least = edges.groupBy(*by, "u").agg(F.min("v").alias("m"))
    moved = edges.join(splittable(least), [*by, "u"]).where("v <> m")
    pointed = moved.select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
    return pointed.unionByName(least.select(*by, "u", F.col("m").alias("v"))).distinct()


class _Links:
    """Neighbour weights and links of the points of a group, block by block.

    A point is sure as soon as its own weight and those of the neighbours seen reach
    ``min_weight``: more of the group cannot change that it is core.
    """

    def __init__(self, cols: dict[str, np.ndarray], near, count: int, min_weight: int):
        self._near, self._min = near, min_weight
        # Least ids come first, so that groups tend to name the same roots.
        self._code, self._ids = pd.factorize(cols["id"], sort=True)
        self._weight = cols["weight"].astype("int64")
        n, named = len(self._ids), self._code >= 0
        own = np.full(n, np.iinfo("int64").max)
        np.minimum.at(own, self._code[named], self._weight[named])
        self._need = min_weight - own
        self._counts = np.zeros((count, n), "int64")
        self._roots = np.tile(np.arange(n), (count, 1))
        self._sure = np.tile(self._need <= 0, (count, 1))
        ball, _ = pd.factorize(cols["ball"])
        inner = np.flatnonzero((ball >= 0) & named)
        if len(inner):
            _, first, place = np.unique(ball[inner], return_index=True, return_inverse=True)
            for roots in self._roots:
                _join(roots, self._code[inner], self._code[inner[first]][place])
            self._sure[:, self._code[inner]] = True
        self._open = [[] for _ in range(count)]
        self._done = np.zeros(len(self._code), bool)
        self._taken, self._size = [], 0

    def needed(self, block: _Block) -> list[_Block]:
        """The block without the pairs of core points that are known to hang together at every eps."""
        return block.without(self._done)

    def add(self, block: _Block) -> None:
        self._taken.append((*block.numbers(), block.distance))
        self._size += len(block.rows)
        if self._size >= _TAKEN:
            self._settle()

    def overflow(self) -> list[dict[str, np.ndarray]]:
        """Links that are too many to keep."""
        waiting = sum(len(u) for links in self._open for u, _ in links)
        return self._singles() if waiting > MATRIX_VALUES else []

    def rest(self) -> list[dict[str, np.ndarray]]:
        self._settle()
        out = self._singles()
        for k, (counts, roots, sure) in enumerate(zip(self._counts, self._roots, self._sure)):
            met = np.flatnonzero(counts)
            out.append(self._rows(k, met, np.where(sure[met], roots[met], met), counts[met], sure[met]))
        return out

    def _settle(self) -> None:
        if not self._taken:
            return
        i, j, distance = (np.concatenate(part) for part in zip(*self._taken))
        self._taken, self._size = [], 0
        u, v, n = self._code[i], self._code[j], len(self._ids)
        for k, near in enumerate(self._near(distance)):
            if not near.any():
                continue
            one, two, named = u[near], v[near], [u[near] >= 0, v[near] >= 0]
            self._counts[k] += np.bincount(one[named[0]], self._weight[j[near]][named[0]], n).astype("int64")
            self._counts[k] += np.bincount(two[named[1]], self._weight[i[near]][named[1]], n).astype("int64")
            self._sure[k] |= self._counts[k] >= self._need
            link = named[0] & named[1] & (one != two)
            self._link(k, one[link], two[link])
            if sum(len(a) for a, _ in self._open[k]) > MATRIX_VALUES // 4:
                self._link(k, *self._waiting(k))
        done = np.ones(n, bool)
        for roots, sure in zip(self._roots, self._sure):
            done &= sure
            if not done.any():
                break
            done &= roots == np.bincount(roots[done], minlength=n).argmax()
        self._done = np.append(done, False)[self._code]

    def _link(self, k: int, u: np.ndarray, v: np.ndarray) -> None:
        both = self._sure[k][u] & self._sure[k][v]
        _join(self._roots[k], u[both], v[both])
        if not both.all():
            self._open[k].append((u[~both], v[~both]))

    def _waiting(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        links, self._open[k] = self._open[k], []
        u, v = (np.concatenate(part) for part in zip(*links)) if links else (np.zeros(0, "int64"),) * 2
        return u, v

    def _singles(self) -> list[dict[str, np.ndarray]]:
        """Links of points that are not sure, which are no longer kept."""
        out = []
        for k in range(len(self._open)):
            self._link(k, *self._waiting(k))
            u, v = self._waiting(k)
            out.append(self._rows(k, u, v, np.zeros(len(u), "int64"), np.zeros(len(u), bool)))
        return out

    def _rows(self, k: int, u: np.ndarray, v: np.ndarray, seen: np.ndarray, sure: np.ndarray) -> dict[str, np.ndarray]:
        numbers = np.full(len(u), k, "int32")
        return {"k": numbers, "id": self._ids[u], "other": self._ids[v], "seen": seen, "sure": sure}


def _join(roots: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Put nodes that are linked under the least root of theirs, by hooking and pointer jumping."""
    while True:
        apart = roots[u] != roots[v]
        u, v = u[apart], v[apart]
        if not len(u):
            return
        ends = roots[u], roots[v]
        for end in ends:
            np.minimum.at(roots, end, np.minimum(*ends))
        while not np.array_equal(roots, roots[roots]):
            roots[:] = roots[roots]
