"""Exact cosine neighbours without a cross join.

Vectors are assigned to cells such that any two closer than the radius share
one. Cells are cut into blocks of bounded size, and each pair of blocks is one
small group: a hot cell becomes many groups instead of a large one. The blocks
are compared with a matrix product inside the task, and only results leave it.

Dense vectors are first turned such that their leading values hold most of their length.
A product of two is at most the product of their leading values and the lengths of what
is left, so most pairs are told apart after a few of their values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from copy import copy

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemark.functions.vectors import (
    AttributeSlice,
    as_array,
    attribute_entries,
    l2_norm,
    scaled_entries,
    unit_entries,
)
from tidemark.session import cut_lineage, splittable, stored

# Distances are compared after rounding to four decimals.
DECIMALS = 4
ROUNDING = 0.00005

# Two blocks make a 2048 x 2048 matrix of 32 MB in a task.
BLOCK_ROWS = 2048
# Values of a dense matrix that a task holds at a time: 32 MB of doubles.
MATRIX_VALUES = 4_000_000
# Groups per shuffle partition at least, as even few points can be much work.
GROUPS_PER_PARTITION = 4
# Rows and dimensions that directions are fitted on, and how many directions there are.
FIT_ROWS, FIT_DIMS, HEAD = 2048, 1024, 64
# Points of a cell of dense vectors at least, and the cells that few points have.
CELL_ROWS, FEW_CELLS = 1024, 16
# Cells that are left where points visit more than this share of the cells they may visit, and the
# rows of such a cell that a task compares with as many others: 2 x 67 MB of leading values.
MERGED_CELLS, _OPEN, MOST_ROWS = 8, 0.5, 131_072
# After how many leading values pairs are looked at again; below this share of pairs, one by one.
_STOPS = (8, 16, 24, 32, 48, 64)
_FEW = 0.1
# Rows of a block that are multiplied at a time, as single precision and in the processor's cache, and what
# that may be off for vectors of length one. Above this share, pairs that are left are multiplied together.
_STRIP, _SINGLE, _MANY = 256, 1e-5, 0.02
# Rows and mean entries of cells of sparse vectors whose pairs are looked up together, and entries that are at a time.
_SMALL, _SHORT, _LOOKUPS = 512, 32, 1_000_000

# Counters of how many sparse vectors have a dimension, and of rows by cell: a fixed number. Rows of a
# vector tell their place in this order, some at a time.
_SLOTS, _CUT_ROWS = 1 << 21, 4096
# Rows of sparse vectors that are sent to cells in one turn.
TURN_ROWS = 1 << 25

# Roles of a point in a cell, and the pairs of roles that are compared there. Points
# at home meet all others; inner points are known to be near each other; points from
# outside meet each other in another cell.
_HOME, _INNER, _OUTER = 0, 1, 2
_TASK = ["cell", "kind", "p", "q"]


def _meetings(role: int, others: str, kind: int, first: bool) -> str:
    """SQL for the tasks of a block with all blocks of another role."""
    p, q = ("own", "n") if first else ("n", "own")
    if role == _HOME and others == "homes":
        p, q, second = "least(n, own)", "greatest(n, own)", "own > n"
    else:
        second = str(not first).lower()
    numbers = f"if({others} > 0, sequence(0, {others} - 1), cast(array() as array<int>))"
    return f"transform({numbers}, n -> named_struct('kind', {kind}, 'p', {p}, 'q', {q}, 'second', {second}))"


_TASKS = f"""case role
    when {_HOME} then concat(
        {_meetings(_HOME, "homes", 0, True)},
        {_meetings(_HOME, "inners", 1, True)},
        {_meetings(_HOME, "outers", 2, True)})
    when {_INNER} then concat(
        {_meetings(_INNER, "homes", 1, False)},
        {_meetings(_INNER, "outers", 3, True)})
    else concat(
        {_meetings(_OUTER, "homes", 2, False)},
        {_meetings(_OUTER, "inners", 3, False)}) end"""


def unit_vectors(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    layout: Sequence[AttributeSlice] | None = None,
) -> DataFrame:
    """``(id, entries)`` for the global distance, or the per-attribute one with a layout."""
    values = as_array(df, vector_col)
    entries = attribute_entries(values, layout) if layout else unit_entries(values)
    return df.select(F.col(id_col).alias("id"), entries.alias("entries"))


def unit_vectors_long(df: DataFrame, id_col: str, dim_col: str, value_col: str) -> DataFrame:
    """``(id, entries)`` from ``(id, dim, value)`` rows, one per non-zero dimension."""
    entry = F.struct(F.col(dim_col).cast("int").alias("dim"), F.col(value_col).cast("double").alias("val"))
    rows = df.where(F.col(value_col) != 0).groupBy(F.col(id_col).alias("id")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries")
    )
    unit = scaled_entries(F.col("entries"), 1 / l2_norm(F.col("entries.val")))
    return rows.select("id", unit.alias("entries"))


def dedupe_vectors(vectors: DataFrame) -> DataFrame:
    """``(id, entries, weight)``: the least id per distinct vector and its multiplicity."""
    return vectors.groupBy("entries").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("weight")
    ).select("id", "entries", "weight")


def vector_members(vectors: DataFrame, points: DataFrame) -> DataFrame:
    """``(id, point)``: the representative of every vector."""
    # Vectors meet by a hash; entries are only sent where points differ but not in it, which are hardly any.
    reps = points.where(F.col("entries").isNotNull()).select(F.xxhash64("entries").alias("hash"), F.col("id").alias("point"), "entries")
    hashed = vectors.where(F.col("entries").isNotNull()).select(F.xxhash64("entries").alias("hash"), "id", "entries")
    known = reps.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("point").alias("point"))
    alone = hashed.select("hash", "id").join(splittable(known.where("n = 1").select("hash", "point")), "hash")
    clash = F.broadcast(known.where("n > 1").select("hash"))
    several = hashed.join(clash, "hash").join(reps.join(clash, "hash"), ["hash", "entries"])
    return alone.select("id", "point").unionByName(several.select("id", "point"))


def cosine_pairs(
    vectors: DataFrame,
    eps: float,
    *,
    cells: str = "anchors",
    faithful_zero_distance: bool = False,
    block_rows: int | None = None,
    anchors: int | None = None,
) -> DataFrame:
    """``(i, j, dist)`` with ``i < j`` for all pairs of unit vectors closer than ``eps``.

    ``dist`` is the cosine distance rounded to four decimals. With
    ``faithful_zero_distance`` pairs at distance 0 are left out.
    """
    radius = cosine_radius(eps)
    points = assign_cells(
        cut_lineage(vectors.select("id", "entries")), radius, cells=cells, anchors=anchors
    )
    id_type = points.schema["id"].dataType.simpleString()
    near = _nearness("cosine", [eps], faithful_zero_distance)

    def pairs(block: _Block) -> dict[str, np.ndarray]:
        (hit,) = near(block.distance)
        i, j = block.left("id")[block.rows[hit]], block.right("id")[block.cols[hit]]
        swap = i > j
        return {
            "i": np.where(swap, j, i),
            "j": np.where(swap, i, j),
            "dist": _rounded(block.distance[hit]),
        }

    schema = f"i {id_type}, j {id_type}, dist double"
    return compare_blocks(points, pairs, schema, radius, block_rows)


def cosine_radius(eps: float) -> float:
    """Bound on the exact distance of pairs whose rounded distance is below ``eps``."""
    if not 0 < eps <= 1:
        raise ValueError("eps must lie in (0, 1]: only vectors that share a dimension are neighbours")
    return eps + ROUNDING + 1e-9


def euclidean_radius(eps: float) -> float:
    """Cosine distance of unit vectors that lie ``eps`` apart."""
    if not 0 < eps < 1:
        raise ValueError("eps must lie in (0, 1)")
    return eps * eps / 2 + 1e-9


def assign_cells(
    points: DataFrame,
    radius: float,
    *,
    cells: str = "anchors",
    anchors: int | None = None,
    dense: tuple[float, int] | None = None,
) -> DataFrame:
    """Add ``cells``, such that points within ``radius`` share one, and ``leader``.

    ``points`` should be stored, since they are read several times; the result is
    written to the checkpoint folder where it takes work to find.

    ``cells="prefix"`` is for sparse vectors: a point joins the cells of its rarest
    dimensions, as many as are needed before the rest is too short to reach the
    similarity alone (prefix filtering, Bayardo et al., WWW 2007). How rare a dimension is is counted by hash,
    in a fixed number of counters that are sent to all tasks; a dimension of one vector is no cell.
    ``cells="anchors"`` is for dense ones: a point is at home with its nearest
    anchor and is copied to other anchors whose region comes within the radius
    (ClusterJoin, Das Sarma et al., VLDB 2014) and whose points, all within a known
    distance of their anchor, can be that near. Distances are those of the leading values
    (``head``), which are never longer than the real ones. There are at most as many
    anchors as the root of the number of points. Zero vectors have no neighbours and get no cell.

    ``dense=(reach, weight)`` spares the comparisons within a dense ball: points
    closer than ``reach`` to their anchor, if their weights add up to ``weight``, are
    not compared with each other and name the least of them as ``leader``.
    """
    points = points.where(F.size("entries") > 0)
    if cells == "prefix":
        return stored(_prefix_cells(points, radius), "cells")
    if cells != "anchors":
        raise ValueError("cells must be 'anchors' or 'prefix'")
    if anchors is None:
        # The root balances the work of finding cells and of comparing within them.
        count = points.count()
        anchors = max(1, min(math.isqrt(count), max(FEW_CELLS, count // CELL_ROWS)))
    return cut_lineage(_anchor_cells(points, radius, anchors, dense))


def compare_blocks(
    points: DataFrame,
    kernel: Callable[[_Block], dict[str, np.ndarray]],
    schema: str,
    radius: float,
    block_rows: int | None = None,
    *,
    gather: bool = False,
    turn: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Run ``kernel`` on every pair of blocks of every cell with its pairs within ``radius``.

    With ``gather`` the kernel is called with the columns of a whole group instead. What it returns
    names the blocks that are still to be compared (``needed``), takes in each with its pairs (``add``),
    and hands out rows in between (``overflow``) and at the end (``rest``), as lists of columns.

    A block of dense vectors grows with the points up to ``MOST_ROWS``, so that a point is sent
    to about as many groups at any size; a task compares ``BLOCK_ROWS`` of its rows at a time with
    as many others. Cells that fit one block are bundled by hash, about ``block_rows`` rows to a
    group, but into some groups per partition in any case; each block pair of a larger
    cell is a group of its own. ``turn`` is the number of a part of the groups, of so many.
    """
    extra = [c for c in points.columns if c not in ("entries", "cells", "prefix", "leader")]
    vector = ["entries.dim dims", "entries.val vals"] if "entries" in points.columns else []
    parts = ["dims", "vals"] if vector else []
    dense = "head" in points.columns
    if block_rows is None:
        block_rows = BLOCK_ROWS
        if dense:
            # Half as much again as a merged cell, as these are not quite equal and one should be one block.
            block_rows = max(block_rows, min(MOST_ROWS, 3 * points.count() // (2 * MERGED_CELLS)))
    at = points.select(F.explode("cells").alias("at"))
    slot = F.pmod(F.xxhash64("at.cell"), F.lit(_SLOTS))
    # Counters show which cells of sparse vectors fit one block for sure; only others are counted one by one.
    counted = at.groupBy(slot.alias("slot")).agg(F.expr("count(*) rows"))
    many = F.broadcast(counted.where(F.col("rows") > block_rows).select("slot"))
    if not dense:
        at = at.withColumn("slot", slot).join(many, "slot", "left_semi")
    sizes = (
        at.groupBy(F.col("at.cell").alias("cell"))
        .agg(
            F.expr("count(*) rows"),
            F.expr(f"count_if(at.role = {_HOME}) home_rows"),
            F.expr(f"count_if(at.role = {_INNER}) inner_rows"),
        )
        .where("home_rows > 1 or (rows > 1 and rows - greatest(home_rows, inner_rows, rows - home_rows - inner_rows) > 0)")
    )
    partitions = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(GROUPS_PER_PARTITION * partitions).cast("long")
    bundles = (sizes if dense else counted).agg(F.greatest(F.ceil(F.sum("rows") / block_rows), least)).scalar()
    blocks = sizes.selectExpr(
        "cell",
        f"cast(ceil(home_rows / {block_rows}) as int) homes",
        f"cast(ceil(inner_rows / {block_rows}) as int) inners",
        f"cast(ceil((rows - home_rows - inner_rows) / {block_rows}) as int) outers",
    )
    placed = points.selectExpr(
        *extra, *vector, "prefix", "posexplode(cells) as (pos, at)"
    ).selectExpr(
        *extra, *parts, "at.cell", "at.role",
        "if(prefix is null, null, slice(prefix, 1, pos)) earlier",
    )
    if dense:
        # There are no more cells of dense vectors than anchors, which are sent to the tasks as well.
        placed = placed.join(F.broadcast(blocks), "cell")
    else:
        # Sparse vectors are at home in all their cells.
        slot = F.pmod(F.xxhash64("cell"), F.lit(_SLOTS))
        one = [F.lit(1).alias("homes"), F.lit(0).alias("inners"), F.lit(0).alias("outers")]
        fitting, larger = (placed.withColumn("slot", slot).join(many, "slot", how).drop("slot") for how in ("left_anti", "left_semi"))
        placed = fitting.select("*", *one).unionByName(larger.join(splittable(blocks), "cell"))
    own = f"case role when {_HOME} then homes when {_INNER} then inners else outers end"
    jobs = (
        placed.withColumn("own", F.expr(f"cast(pmod(xxhash64(id), {own}) as int)"))
        .selectExpr("*", f"explode({_TASKS}) task")
        .selectExpr(
            "cell", "task.*", *extra, *parts, "earlier", "greatest(homes, inners, outers) = 1 as fits"
        )
        .withColumn(
            "bundle",
            F.when(F.col("fits"), F.pmod(F.xxhash64("cell"), bundles)).otherwise(F.xxhash64(*_TASK)),
        )
        .drop("fits")
    )
    if turn[1] > 1:
        jobs = jobs.where(F.pmod(F.xxhash64("bundle"), F.lit(turn[1])) == turn[0])
    columns = [part.strip().split()[0] for part in schema.split(",")]

    target = points.sparkSession.createDataFrame([], schema).toArrow().schema

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([(c, "ascending") for c in _TASK]).combine_chunks()
        keys = np.stack([table[c].to_numpy() for c in _TASK], axis=1).astype("int64")
        starts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        lists = {} if dense else {c: _ragged(table[c]) for c in ("dims", "vals", "earlier")}
        edges = np.concatenate([[0], starts, [len(table)]])
        small = np.zeros(len(edges) - 1, bool)
        if not dense:
            _, kind, p, q = keys[edges[:-1]].T
            small = (kind == 0) & (p == q) & _is_small(lists["dims"][1], edges)
        # Rows of small cells are not needed as single arrays.
        cols = {c: table[c].to_pandas().to_numpy() for c in table.column_names if c != "head" and not (c in lists and small.all())}
        if "head" in table.column_names:
            cols["head"] = table["head"].chunk(0).flatten().to_numpy().reshape(len(table), -1)
        whole = kernel(cols) if gather else None

        def near() -> Iterator[_Block]:
            """The blocks with pairs within the radius."""
            if small.any():
                yield from _small_cells(cols, lists, edges, small, radius)
            for n in np.flatnonzero(~small):
                _, kind, p, q = keys[edges[n]]
                for block in _Block(cols, np.arange(edges[n], edges[n + 1]), diagonal=kind == 0 and p == q).tiles():
                    for part in whole.needed(block) if gather else [block]:
                        if part.compare(radius):
                            yield part

        found, size = [], 0
        for block in near():
            if gather:
                whole.add(block)
                yield from _batches(whole.overflow(), columns, target)
                continue
            found.append(kernel(block))
            size += len(found[-1][columns[0]])
            if size >= MATRIX_VALUES:
                yield from _batches(found, columns, target)
                found, size = [], 0
        yield from _batches(whole.rest() if gather else found, columns, target)

    # Little data but much work: keep the groups spread over all shuffle partitions.
    return jobs.repartition(partitions, "bundle").groupBy("bundle").applyInArrow(compared, schema)


def _batches(found: list[dict], columns: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if found:
        frame = pd.DataFrame({c: _column([f[c] for f in found]) for c in columns})
        yield from pa.Table.from_pandas(frame, schema=schema, preserve_index=False).to_batches()


class _Block:
    """Two blocks of one cell (the same block twice on the diagonal)."""

    def __init__(self, cols: dict[str, np.ndarray], rows: np.ndarray, diagonal: bool):
        self.diagonal = diagonal
        self._cols = cols
        second = cols["second"][rows]
        self._sides = [rows] if diagonal else [rows[~second], rows[second]]

    def tiles(self) -> Iterator[_Block]:
        """All pairs of rows, in blocks of at most ``BLOCK_ROWS`` rows."""
        sides = [[side[at : at + BLOCK_ROWS] for at in range(0, len(side), BLOCK_ROWS)] for side in self._sides]
        for n, left in enumerate(sides[0]):
            for m, right in enumerate(sides[-1]):
                if not self.diagonal or m >= n:
                    yield self._of([left] if self.diagonal and m == n else [left, right])

    def without(self, done: np.ndarray) -> list[_Block]:
        """The same pairs of rows but for those of two rows that are ``done``."""
        sides = [(side[~done[side]], side[done[side]]) for side in self._sides]
        if not all(len(settled) for _, settled in sides):
            return [self]
        (left, first), (right, _) = sides[0], sides[-1]
        if self.diagonal:
            return [self._of([left]), self._of([left, first])]
        return [self._of([left, self._sides[1]]), self._of([first, right])]

    def _of(self, sides: list[np.ndarray]) -> _Block:
        part = copy(self)
        part.diagonal, part._sides = len(sides) == 1, sides
        return part

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs as numbers of rows of the group."""
        return self._sides[0][self.rows], self._sides[-1][self.cols]

    def left(self, col: str) -> np.ndarray:
        return self._cols[col][self._sides[0]]

    def right(self, col: str) -> np.ndarray:
        return self._cols[col][self._sides[-1]]

    def compare(self, radius: float) -> bool:
        """Find the pairs ``(rows, cols)`` within the radius, each once; false if none."""
        if min(map(len, self._sides)) < (2 if self.diagonal else 1):
            return False
        if "head" in self._cols:
            rows, cols, similarity = self._by_head(1 - radius - 1e-9)
        else:
            product = self._product("dims", "vals")
            if product.max() > 1 + 1e-5:
                raise ValueError("vectors are longer than one")
            rows, cols = np.nonzero(product >= 1 - radius - 1e-9)
            similarity = product[rows, cols]
        if self.diagonal:
            once = rows < cols
            rows, cols, similarity = rows[once], cols[once], similarity[once]
        if len(rows) and self._cols["earlier"][self._sides[0][0]] is not None:
            # A pair that shares an earlier cell is reported there.
            here = self._product("earlier", None)[rows, cols] == 0
            rows, cols, similarity = rows[here], cols[here], similarity[here]
        self.rows, self.cols = rows, cols
        self.distance = 1.0 - similarity
        return len(rows) > 0

    def _by_head(self, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a similarity of ``least`` or more, told apart by their leading values as far as these go.

        At every stop the product so far and the lengths of the rest bound the whole product. Up to the
        first stop that leaves few pairs, by some of the rows, all pairs are multiplied in single precision;
        the pairs it leaves are multiplied in double precision. ``multiplied`` counts the values that entered
        products.
        """
        one, two = (self._cols["head"][s] for s in (self._sides[0], self._sides[-1]))
        lengths = [self._cols["square"][s] for s in (self._sides[0], self._sides[-1])]
        if max(length.max() for length in lengths) > 1 + 1e-5:
            raise ValueError("vectors are longer than one")
        ends = [stop for stop in _STOPS if stop < one.shape[1]] + [one.shape[1]]
        few = [(h[:: len(h) // 64 + 1], length[:: len(h) // 64 + 1]) for h, length in zip((one, two), lengths)]
        while len(ends) > 1:
            bound = _with_rest(*few[0], ends[0]) @ _with_rest(*few[1], ends[0]).T
            if (bound >= least).mean() <= _FEW:
                break
            del ends[0]
        rows, cols, product = self._first(one, two, lengths, ends[0], least)
        for begin, end in zip(ends, ends[1:]):
            product = product + _products(one[:, begin:end], rows, two[:, begin:end], cols)
            self.multiplied += len(rows) * (end - begin)
            rest = [_rest(h, length, end) for h, length in zip((one, two), lengths)]
            alive = product + rest[0][rows] * rest[1][cols] >= least
            rows, cols, product = rows[alive], cols[alive], product[alive]
        if not len(rows):
            return rows, cols, product
        if "dims" not in self._cols:
            return rows, cols, product
        # The vectors have more than their leading values: what is left is multiplied whole.
        if len(rows) > _FEW * len(one) * len(two):
            product = self._product("dims", "vals")[rows, cols]
        else:
            left, right = np.unique(rows, return_inverse=True), np.unique(cols, return_inverse=True)
            sides = [_Entries(self._cols["dims"][s[k]], self._cols["vals"][s[k]]) for s, k in zip((self._sides[0], self._sides[-1]), (left[0], right[0]))]
            shared, product = np.intersect1d(sides[0].dims, sides[1].dims), np.zeros(len(rows))
            step = max(1, MATRIX_VALUES // max(side.count for side in sides))
            for at in range(0, len(shared), step):
                part = shared[at : at + step]
                product += _products(sides[0].matrix(part), left[1], sides[1].matrix(part), right[1])
        near = product >= least
        return rows[near], cols[near], product[near]

    def _first(
        self, one: np.ndarray, two: np.ndarray, lengths: list[np.ndarray], end: int, least: float
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that ``end`` leading values leave, and the product of these."""
        rest = [_rest(h, length, end) for h, length in zip((one, two), lengths)]
        left, right = (_with_rest(h, length, end).astype("float32") for h, length in zip((one, two), lengths))
        product = np.empty((_STRIP, len(two)), "float32")
        found, self.multiplied = [], 0
        for at in range(0, len(one), _STRIP):
            # On the diagonal, pairs are above it.
            start = at if self.diagonal else 0
            strip, others = left[at : at + _STRIP], right[start:]
            out = product[: len(strip), start:] if start == 0 else product.reshape(-1)[: len(strip) * len(others)].reshape(len(strip), -1)
            np.matmul(strip, others.T, out=out)
            self.multiplied += out.size * end
            rows, cols = np.divmod(np.flatnonzero(out >= np.float32(least - _SINGLE)), len(others))
            rows, cols = rows + at, cols + start
            if len(rows) > _MANY * out.size:
                exact = one[at : at + _STRIP, :end] @ two[start:, :end].T
                self.multiplied += out.size * end
                exact = exact[rows - at, cols - start]
            else:
                exact = _products(one[:, :end], rows, two[:, :end], cols)
                self.multiplied += len(rows) * end
            alive = exact + rest[0][rows] * rest[1][cols] >= least
            found.append((rows[alive], cols[alive], exact[alive]))
        rows, cols, exact = (np.concatenate(part) for part in zip(*found))
        return rows, cols, exact

    def _product(self, dims: str, vals: str | None) -> np.ndarray:
        """The product of both sides, summed over slices of the dimensions they share."""
        sides = [_Entries(self._cols[dims][s], self._cols[vals][s] if vals else None) for s in self._sides]
        left, right = sides[0], sides[-1]
        shared = np.intersect1d(left.dims, right.dims)
        total = np.zeros((left.count, right.count))
        step = max(1, MATRIX_VALUES // max(left.count, right.count))
        for at in range(0, len(shared), step):
            part = shared[at : at + step]
            total += left.matrix(part) @ right.matrix(part).T
        return total


def _ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, one after the other, and how many each has."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype("int64")
    return pc.list_flatten(column).to_numpy(), lengths


def _is_small(lengths: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Which runs of rows are few, with few entries."""
    sizes = np.diff(edges)
    return (sizes <= _SMALL) & (np.add.reduceat(lengths, edges[:-1]) <= _SHORT * sizes)


def _small_cells(
    cols: dict[str, np.ndarray], lists: dict[str, tuple], edges: np.ndarray, small: np.ndarray, radius: float
) -> Iterator[_Block]:
    """The pairs within the radius of all small cells of a group, some rows at a time."""
    last = np.repeat(edges[1:], np.diff(edges))
    others = np.where(np.repeat(small, np.diff(edges)), last - np.arange(len(last)) - 1, 0)
    if not others.any():
        return
    vectors = _Lookup(*lists["dims"], lists["vals"][0])
    earlier = _Lookup(*lists["earlier"], np.ones(len(lists["earlier"][0])))
    work = np.cumsum(others * (vectors.lengths + 1)) // _LOOKUPS
    for rows in np.split(np.arange(len(last)), np.flatnonzero(np.diff(work)) + 1):
        first = np.repeat(rows, others[rows])
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(others[rows]) - others[rows], others[rows])
        similarity = vectors.products(first, second)
        if similarity.max(initial=0) > 1 + 1e-5:
            raise ValueError("vectors are longer than one")
        hit = similarity >= 1 - radius - 1e-9
        first, second, similarity = first[hit], second[hit], similarity[hit]
        # A pair that shares an earlier cell is reported there.
        here = earlier.products(first, second) == 0
        block = _Block.__new__(_Block)
        block.diagonal, block._cols, block._sides = False, cols, [first[here], second[here]]
        block.rows = block.cols = np.arange(len(block._sides[0]))
        block.distance = 1.0 - similarity[here]
        if len(block.rows):
            yield block


class _Lookup:
    """Sparse rows whose entries are looked up by row and dimension."""

    def __init__(self, dims: np.ndarray, lengths: np.ndarray, vals: np.ndarray):
        self.lengths = lengths
        self._begin = np.cumsum(lengths) - lengths
        used, place = np.unique(dims, return_inverse=True)
        self._width = len(used)
        keys = np.repeat(np.arange(len(lengths)), lengths) * self._width + place
        order = np.argsort(keys, kind="stable")
        self._keys, self._vals = keys[order], vals[order]

    def products(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Products of pairs of rows."""
        counts = self.lengths[first]
        pair = np.repeat(np.arange(len(first)), counts)
        if not len(pair):
            return np.zeros(len(first))
        at = np.arange(len(pair)) + np.repeat(self._begin[first] - np.cumsum(counts) + counts, counts)
        want = self._keys[at] + np.repeat((second - first) * self._width, counts)
        other = np.minimum(np.searchsorted(self._keys, want), len(self._keys) - 1)
        hit = self._keys[other] == want
        return np.bincount(pair[hit], self._vals[at[hit]] * self._vals[other[hit]], len(first))


class _Entries:
    """Sparse rows with their entries sorted by dimension."""

    def __init__(self, dims: np.ndarray, vals: np.ndarray | None):
        self.count = len(dims)
        flat = np.concatenate([np.asarray(d, dtype="int64") for d in dims])
        rows = np.repeat(np.arange(len(dims)), [len(d) for d in dims])
        order = np.argsort(flat, kind="stable")
        self.dims, self.rows = flat[order], rows[order]
        self.vals = np.ones(len(flat)) if vals is None else np.concatenate(list(vals))[order]

    def matrix(self, part: np.ndarray) -> np.ndarray:
        """Dense rows over the sorted dimensions ``part``."""
        out = np.zeros((self.count, len(part)))
        at = slice(np.searchsorted(self.dims, part[0]), np.searchsorted(self.dims, part[-1], "right"))
        dims = self.dims[at]
        cols = np.searchsorted(part, dims)
        hit = part[np.minimum(cols, len(part) - 1)] == dims
        out[self.rows[at][hit], cols[hit]] = self.vals[at][hit]
        return out


def _dense(dims: list, vals: list | None, used: np.ndarray) -> np.ndarray:
    """Rows of (dims, vals) over the sorted dimensions ``used``; others are left out."""
    matrix = np.zeros((len(dims), len(used)))
    if not len(used):
        return matrix
    flat = np.concatenate(dims)
    rows = np.repeat(np.arange(len(dims)), [len(d) for d in dims])
    cols = np.minimum(np.searchsorted(used, flat), len(used) - 1)
    hit = used[cols] == flat
    matrix[rows[hit], cols[hit]] = 1.0 if vals is None else np.concatenate(vals)[hit]
    return matrix


def _column(parts: list[np.ndarray]):
    whole = np.concatenate(parts)
    return pd.Series(list(whole), dtype=object) if whole.ndim > 1 else whole


def _rounded(distance: np.ndarray) -> np.ndarray:
    return np.round(np.maximum(distance, 0.0), DECIMALS)


def _nearness(
    metric: str, eps_values: Sequence[float], faithful: bool
) -> Callable[[np.ndarray], list[np.ndarray]]:
    """Which pairs are neighbours by their cosine distances, one mask per eps."""

    def near(distance: np.ndarray) -> list[np.ndarray]:
        if metric == "euclidean":
            apart = np.sqrt(np.maximum(2.0 * distance, 0.0))
            return [apart <= eps for eps in eps_values]
        dist = _rounded(distance)
        least = 0.0 if faithful else -1.0
        return [(dist < eps) & (dist > least) for eps in eps_values]

    return near


def _no_prefix() -> Column:
    return F.lit(None).cast("array<int>").alias("prefix")


def _no_leader(points: DataFrame) -> Column:
    return F.lit(None).cast(points.schema["id"].dataType).alias("leader")


def _slots(dims: np.ndarray) -> np.ndarray:
    """The counter of each dimension."""
    hashes = dims.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (hashes >> np.uint64(65 - _SLOTS.bit_length())).astype(np.int64)


def _dims_vals(entries: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, dimension and value of all entries that have a dimension."""
    sizes = pc.fill_null(pc.list_value_length(entries), 0).to_numpy()
    dims, vals = (pc.struct_field(pc.list_flatten(entries), name) for name in ("dim", "val"))
    known = pc.is_valid(dims).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(sizes)), sizes)[known]
    return owner, pc.fill_null(dims, 0).to_numpy()[known], pc.fill_null(vals, 0.0).to_numpy()[known]


def _common_dims(points: DataFrame) -> np.ndarray:
    """How many vectors have the dimensions of each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            total += np.bincount(_slots(_dims_vals(batch.column(0))[1]), minlength=_SLOTS)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], names=["slot", "n"])

    rows = points.select("entries").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_SLOTS, np.int64)
    counts[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _prefix_cells(points: DataFrame, radius: float) -> DataFrame:
    # Null ids are no neighbours.
    points = points.where(F.col("id").isNotNull())
    shared = points.sparkSession.sparkContext.broadcast(_common_dims(points))
    names = points.columns
    at = names.index("entries")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, _CUT_ROWS):
                part = batch.slice(begin, _CUT_ROWS)
                owner, dims, vals = _dims_vals(part.column(at))
                common = counts[_slots(dims)]
                order = np.lexsort((dims, common, owner))
                owner, dims, common, squares = owner[order], dims[order], common[order], vals[order] ** 2
                ends = np.searchsorted(owner, np.arange(part.num_rows) + 1)
                after = np.append(np.cumsum(squares[::-1])[::-1], 0.0)
                rest = np.sqrt(np.maximum(after[:-1] - after[ends[owner]], 0.0))
                # Sums over many rows are less exact; a dimension more does not matter. Values that are no numbers stay.
                needed = ~(rest < 1 - radius - 1e-6) & (common > 1)
                offsets = np.append(0, np.cumsum(np.bincount(owner[needed], minlength=part.num_rows)))
                prefix = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(dims[needed], pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, prefix], [*names, "prefix"])

    schema = StructType([*points.schema.fields, StructField("prefix", ArrayType(IntegerType()))])
    placed = points.mapInArrow(cut, schema).where(F.size("prefix") > 0)
    cells = F.transform(
        "prefix", lambda d: F.struct(d.alias("cell"), F.lit(_HOME).alias("role"))
    )
    return placed.select(*points.columns, cells.alias("cells"), "prefix", _no_leader(points))


def _anchor_cells(
    points: DataFrame, radius: float, anchors: int, dense: tuple[float, int] | None
) -> DataFrame:
    context = points.sparkSession.sparkContext
    ranked = points.orderBy(F.xxhash64("id"), "id")
    sample = ranked.limit(FIT_ROWS).select(F.col("entries.dim").alias("dims"), F.col("entries.val").alias("vals")).toPandas()
    fitted = _directions(sample)
    turn = context.broadcast(fitted)

    @F.pandas_udf("array<double>")
    def turned(dims: pd.Series, vals: pd.Series) -> pd.Series:
        used, directions = turn.value
        step = max(1, MATRIX_VALUES // max(1, len(used)))
        parts = [
            _dense(list(dims[at : at + step]), list(vals[at : at + step]), used) @ directions
            for at in range(0, len(dims), step)
        ]
        return pd.Series([row for part in parts for row in part], dtype=object)

    square = F.aggregate("entries.val", F.lit(0.0), lambda total, v: total + v * v)
    points = points.withColumns({"head": turned(F.col("entries.dim"), F.col("entries.val")), "square": square})
    if anchors <= FIT_ROWS:
        first = sample.iloc[:anchors]
        centres = _dense(list(first["dims"]), list(first["vals"]), fitted[0]) @ fitted[1]
    else:
        points = cut_lineage(points)
        first = points.orderBy(F.xxhash64("id"), "id").limit(anchors).select("head").toArrow()["head"].combine_chunks()
        centres = first.flatten().to_numpy().reshape(len(first), fitted[1].shape[1])
    if dense is not None and len(centres):
        centres = _thinned(centres, dense[0])
    sent = context.broadcast(centres)
    reach = np.sqrt(2.0 * radius)

    def apart(heads: pd.Series) -> Iterator[np.ndarray]:
        """Distances from all anchors, some points at a time."""
        step = max(1, MATRIX_VALUES // max(1, len(sent.value)))
        for at in range(0, len(heads), step):
            yield _distances(np.stack(list(heads[at : at + step])), sent.value)

    @F.pandas_udf("home int, gap double")
    def settle(heads: pd.Series) -> pd.DataFrame:
        parts = [(a.argmin(axis=1), a.min(axis=1)) for a in apart(heads)]
        home, gap = (np.concatenate(p) for p in zip(*parts)) if parts else ([], [])
        return pd.DataFrame({"home": home, "gap": gap})

    settled = points.withColumn("at", settle("head"))
    settled = cut_lineage(settled.select(*points.columns, "at.home", "at.gap"))
    widths, rows = np.full(len(centres), -np.inf), np.zeros(len(centres), "int64")
    is_ball, inside = np.zeros(len(centres), bool), np.zeros(len(centres), "int64")
    rest = F.greatest(F.col("square") - F.aggregate("head", F.lit(0.0), lambda total, v: total + v * v), F.lit(0.0))
    whole = True
    # The distance from an anchor is that of the leading values and of the rest.
    in_ball = F.lit(False) if dense is None else F.sqrt(F.col("gap") * F.col("gap") + rest) <= dense[0]
    weight = F.lit(0) if dense is None else F.sum(F.when(in_ball, F.col("weight")))
    for row in settled.groupBy("home").agg(
        F.max("gap").alias("width"), F.max(rest).alias("rest"), F.count(F.lit(1)).alias("rows"), weight.alias("total"),
        F.count(F.when(in_ball, 1)).alias("inside"),
    ).collect():
        widths[row["home"]], rows[row["home"]] = row["width"], row["rows"]
        is_ball[row["home"]] = dense is not None and (row["total"] or 0) >= dense[1]
        inside[row["home"]] = row["inside"]
        whole = whole and row["rest"] < 1e-12
    # How many cells points visit is told by the rows that directions are fitted on, but for the anchors among many.
    few = sample if len(sample) < FIT_ROWS else sample.iloc[min(anchors, FIT_ROWS // 2) :]
    near = _distances(_dense(list(few["dims"]), list(few["vals"]), fitted[0]) @ fitted[1], centres)
    visits = len(_visits(near, near.argmin(axis=1), centres, widths, reach)[0]) if near.size else 0
    # Balls with fewer points than a merged cell would only make more cells: they spare few comparisons.
    large = is_ball & (inside * MERGED_CELLS >= rows.sum())
    groups = _merged(rows, large, visits / max(1, len(few)) * rows.sum())
    wide = context.broadcast((widths, groups))

    @F.pandas_udf("cell int, others array<int>, single boolean")
    def visit(heads: pd.Series, home: pd.Series) -> pd.DataFrame:
        widths, groups = wide.value
        out, done, count = [], 0, len(groups)
        for a in apart(heads):
            at_home = home.to_numpy(dtype="int64")[done : done + len(a)]
            done += len(a)
            rows, cells = _visits(a, at_home, sent.value, widths, reach)
            rows, cells = np.divmod(np.unique(rows * count + groups[cells]), count)
            other = cells != groups[at_home][rows]
            out += np.split(cells[other].astype("int32"), np.searchsorted(rows[other], np.arange(1, len(a))))
        cell = groups[home.to_numpy(dtype="int64")]
        return pd.DataFrame(
            {"cell": cell, "others": pd.Series(out, dtype=object), "single": np.bincount(groups)[cell] == 1}
        )

    placed = settled.withColumn("visited", visit("head", "home")).select(
        *settled.columns, "visited.cell", "visited.others", "visited.single"
    )
    cells = (
        f"concat(array(named_struct('cell', cell, 'role', {_HOME})), "
        f"transform(others, c -> named_struct('cell', c, 'role', {_OUTER})))"
    )
    placed = placed.withColumn("cells", F.expr(cells))
    columns = [c for c in points.columns if c != "entries" or not whole]
    if dense is None:
        return placed.select(*columns, "cells", _no_prefix(), _no_leader(points))
    ball = F.when(in_ball, F.col("home")).alias("ball")
    placed = placed.withColumn("ball", ball)
    balls = (
        settled.select("*", ball).where(F.col("ball").isNotNull())
        .groupBy("ball")
        .agg(F.min("id").alias("leader"), F.sum("weight").alias("total"))
        .where(F.col("total") >= dense[1])
        .select("ball", "leader")
    )
    # Points of a ball that is part of a merged cell keep their leader and are compared like others.
    inner = F.expr(f"transform(cells, c -> named_struct('cell', c.cell, 'role', "
                   f"if(c.role = {_HOME} and single and leader is not null, {_INNER}, c.role)))")
    # There are no more balls than anchors. Most points are in none, which a shuffle would send to one task.
    return placed.join(F.broadcast(balls), "ball", "left").select(
        *columns, inner.alias("cells"), _no_prefix(), "leader"
    )


def _visits(
    apart: np.ndarray, home: np.ndarray, centres: np.ndarray, widths: np.ndarray, reach: float
) -> tuple[np.ndarray, np.ndarray]:
    """Points, by their distances from all anchors, and the earlier cells that they are copied to."""
    # The border with another region must be near, and so must that region's points.
    homes, place = np.unique(home, return_inverse=True)
    between = _distances(centres[homes], centres)[place]
    own = apart[np.arange(len(apart)), home][:, None]
    border = apart * apart - own * own <= 2 * between * (reach + 1e-9) + 1e-9
    inside = apart <= reach + widths + 1e-9
    return np.nonzero(border & inside & (np.arange(apart.shape[1]) < home[:, None]))


def _merged(rows: np.ndarray, is_ball: np.ndarray, visits: float) -> np.ndarray:
    """The cell that each cell becomes part of, in the same order.

    Where no bound keeps points out of most cells, a point would be sent to a number of cells that
    grows with the points. Neighbouring numbers are put together to ``MERGED_CELLS`` cells then, as many
    from few cells of unequal size as from many, but for those with a large dense ball, whose points are
    not compared with each other.
    """
    if visits <= _OPEN * (rows * np.arange(len(rows))).sum():
        return np.arange(len(rows), dtype="int32")
    # A cell belongs where the middle of its rows lies.
    part = (np.cumsum(rows) - rows / 2) * MERGED_CELLS // rows.sum()
    begins = (part[1:] != part[:-1]) | is_ball[1:] | is_ball[:-1]
    return np.concatenate([[0], np.cumsum(begins)]).astype("int32")


def _directions(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions that are longest in some rows, and their main directions among them."""
    if not len(rows):
        return np.zeros(0, "int32"), np.zeros((0, 1))
    dims, place = np.unique(np.concatenate(list(rows["dims"])), return_inverse=True)
    energy = np.bincount(place, np.concatenate(list(rows["vals"])) ** 2)
    used = np.sort(dims[np.argsort(-energy, kind="stable")[:FIT_DIMS]])
    matrix = _dense(list(rows["dims"]), list(rows["vals"]), used)
    _, directions = np.linalg.eigh(matrix.T @ matrix)
    return used, np.ascontiguousarray(directions[:, ::-1][:, :HEAD])


def _rest(head: np.ndarray, square: np.ndarray, end: int) -> np.ndarray:
    """Bounds on the lengths of what is left after ``end`` values."""
    seen = np.einsum("ij,ij->i", head[:, :end], head[:, :end])
    return np.sqrt(np.maximum(square - seen, 0)) + 1e-9


def _with_rest(head: np.ndarray, square: np.ndarray, end: int) -> np.ndarray:
    """Rows whose products bound those of the vectors from above."""
    return np.concatenate([head[:, :end], _rest(head, square, end)[:, None]], axis=1)


def _products(one: np.ndarray, rows: np.ndarray, two: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Products of single rows, some at a time."""
    out = np.empty(len(rows))
    step = max(1, MATRIX_VALUES // max(1, one.shape[1]))
    for at in range(0, len(rows), step):
        out[at : at + step] = np.einsum("ij,ij->i", one[rows[at : at + step]], two[cols[at : at + step]])
    return out


def _distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    squares = (one * one).sum(axis=1)[:, None] + (two * two).sum(axis=1) - 2.0 * (one @ two.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _thinned(anchors: np.ndarray, reach: float, block: int = 512) -> np.ndarray:
    """Anchors that lie further than ``reach`` from all kept before them."""
    kept = anchors[:0]
    for at in range(0, len(anchors), block):
        some = anchors[at : at + block]
        if len(kept):
            some = some[_distances(some, kept).min(axis=1) > reach]
        near, own = _distances(some, some) <= reach, []
        for n in range(len(some)):
            if not near[n, own].any():
                own.append(n)
        kept = np.concatenate([kept, some[own]])
    return kept
