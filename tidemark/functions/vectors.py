"""Vector columns as lists of non-zero (dim, val) entries of a unit vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class AttributeSlice(NamedTuple):
    """Columns ``start`` (inclusive) to ``end`` (exclusive) of one attribute."""

    attr: str
    start: int
    end: int
    weight: float


def attribute_layout(
    sizes: Sequence[tuple[str, int]], weights: Mapping[str, float]
) -> list[AttributeSlice]:
    """Consecutive slices for attributes given in column order with their sizes."""
    ends = list(accumulate(size for _, size in sizes))
    return [
        AttributeSlice(attr, end - size, end, float(weights[attr]))
        for (attr, size), end in zip(sizes, ends)
    ]


def as_array(df: DataFrame, col: str) -> Column:
    """A vector or numeric array column as ``array<double>``."""
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return F.col(col).cast("array<double>")
    return vector_to_array(F.col(col))


def vector_entries(df: DataFrame, col: str) -> Column:
    """Non-zero ``(dim, val)`` entries of a vector or numeric array column, by dimension."""
    pair = lambda dim, val: F.struct(dim.cast("int").alias("dim"), val.cast("double").alias("val"))
    if isinstance(df.schema[col].dataType, T.ArrayType):
        entries = F.transform(col, lambda x, n: pair(n, x))
    else:
        # A vector is a struct of its kind (0: sparse), size, indices and values.
        raw = F.unwrap_udt(col)
        sparse = F.transform(F.arrays_zip(raw["indices"].alias("d"), raw["values"].alias("v")), lambda e: pair(e["d"], e["v"]))
        entries = F.when(raw["type"] == 0, sparse).otherwise(F.transform(raw["values"], lambda x, n: pair(n, x)))
    return F.filter(entries, lambda e: e["val"] != 0)


def unit_of_entries(entries: Column, layout: Sequence[AttributeSlice] | None = None) -> Column:
    """Entries scaled to length one, or by attribute as ``attribute_entries`` does."""
    if layout is None:
        norm = l2_norm(entries["val"])
        return scaled_entries(entries, F.when(norm > 0, 1 / norm))
    total = sum(s.weight for s in layout)
    width = max(s.end for s in layout)
    blocks = []
    for n, s in enumerate(layout):
        if s.weight == 0:
            continue
        scale = F.lit((s.weight / total) ** 0.5)
        part = _within(entries, s)
        norm = l2_norm(part["val"])
        marker = F.array(F.struct(F.lit(width + n).alias("dim"), scale.alias("val")))
        blocks.append(F.when(F.size(part) == 0, marker).otherwise(scaled_entries(part, F.when(norm > 0, scale / norm))))
    return F.concat(*blocks)


def _within(entries: Column, part: AttributeSlice) -> Column:
    return F.filter(entries, lambda e: (e["dim"] >= part.start) & (e["dim"] < part.end))


def vector_size(df: DataFrame, col: str) -> Column:
    """Number of dimensions."""
    return F.size(as_array(df, col))


def l2_norm(values: Column) -> Column:
    """Euclidean length of an array."""
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))


def unit_entries(values: Column) -> Column:
    """Non-zero entries of the array scaled to length one; empty for a zero array."""
    return _entries(values, F.lit(0), F.lit(1.0))


def attribute_entries(values: Column, layout: Sequence[AttributeSlice]) -> Column:
    """One unit vector whose dot product is the weighted per-attribute similarity.

    Each slice is scaled to length one and then by the root of its share of the
    weights. An all-zero slice is marked by a dimension of its own past the last
    column, so that two all-zero slices are alike and a zero and a non-zero one
    are not.
    """
    total = sum(s.weight for s in layout)
    width = max(s.end for s in layout)
    blocks = []
    for n, s in enumerate(layout):
        if s.weight == 0:
            continue
        scale = F.lit((s.weight / total) ** 0.5)
        entries = _entries(F.slice(values, s.start + 1, s.end - s.start), F.lit(s.start), scale)
        marker = F.array(F.struct(F.lit(width + n).alias("dim"), scale.alias("val")))
        blocks.append(F.when(F.size(entries) == 0, marker).otherwise(entries))
    return F.concat(*blocks)


def scaled_entries(entries: Column, factor: Column) -> Column:
    """Multiply all values of ``(dim, val)`` entries by one factor per row."""
    # Bound as a lambda variable, the factor is computed once per row, not per entry.
    return F.get(
        F.transform(
            F.array(factor),
            lambda f: F.transform(
                entries, lambda e: F.struct(e["dim"].alias("dim"), (e["val"] * f).alias("val"))
            ),
        ),
        F.lit(0),
    )


def _entries(values: Column, offset: Column, scale: Column) -> Column:
    indexed = F.transform(values, lambda x, n: F.struct((n + offset).alias("dim"), x.alias("val")))
    present = F.filter(indexed, lambda e: e["val"] != 0)
    norm = l2_norm(values)
    return scaled_entries(present, F.when(norm > 0, scale / norm))
