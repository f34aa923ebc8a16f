"""Helpers of the corpus operators: Arrow text as bytes, filters, shares of ids."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

#: Bytes of text that a task turns into numpy arrays at a time.
CHUNK_BYTES = 1 << 20

T = TypeVar("T")


def shared_value(spark: SparkSession, value: T) -> Callable[[], T]:
    """Send a model to all tasks together with its class; what is returned gives them the model."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


class _Made(dict):
    """What a task has made once. It travels empty, so that every task makes its own."""

    def __reduce__(self):
        return _Made, ()


_MADE = _Made()


def made_once(name: str, make: Callable[[], T]) -> T:
    """A value that is the same for all batches of a task."""
    if name not in _MADE:
        _MADE[name] = make()
    return _MADE[name]


def drawn(id_col: str, text_col: str) -> Column:
    """A number of 0 to 1 by the hash of id, text and place, so that even equal rows are drawn one by one.

    It is the same whenever the same files are read in the same parts.
    """
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.pmod(F.xxhash64(text, F.col(text_col), F.monotonically_increasing_id()), F.lit(1 << 30)) / (1 << 30)


def share_of(id_col: str, modulus: int) -> Column:
    """The crc32 of an id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bits per key, and at most in all, of a filter sent to all tasks.
FILTER_BITS = 64
MOST_BITS = 1 << 26


def bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of 64-bit keys by their lowest places, in a size that is bounded whatever their number."""
    count = keys.agg(F.approx_count_distinct(column)).first()[0]
    bits = 1 << max(16, min(MOST_BITS, FILTER_BITS * max(1, count)).bit_length() - 1)
    slots = keys.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("slot"))
    words = slots.groupBy(F.expr("cast(slot div 32 AS int) AS word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 32 AS int))) AS bits")
    )
    rows = words.toArrow()
    found = np.zeros(bits // 32, np.uint32)
    found[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return found


def may_contain(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter has each key; true for all keys put in, and for few others."""
    slot = keys.view(np.uint64) & np.uint64(len(found) * 32 - 1)
    return ((found[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1).astype(bool)


def drop_rows(docs: DataFrame, keys: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows of ``keys``: ``(id, version, once)``, ``version`` being the xxhash64 of the text.

    Of rows whose key has ``once``, one stays. A bit filter of bounded size lets all other
    rows pass where they are, so only rows that may go are shuffled. Texts stay in the JVM.
    """
    marked = keys.select("id", "version", "once", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), "version").alias("hash"))
    marked = stored(marked, "dropped")
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(marked, "hash"))

    @F.pandas_udf("boolean")
    def doubtful(hashes: pd.Series) -> pd.Series:
        return pd.Series(may_contain(shared.value, hashes.to_numpy()))

    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    id_name, text_name = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    version = F.xxhash64(F.col(text_name))
    key = F.xxhash64(F.coalesce(F.col(id_name).cast("string"), F.lit("")), version)
    rows = plain.select(*names, version.alias("version")).withColumn("doubtful", doubtful(key))
    m = marked.select(F.col("id").alias("marked_id"), F.col("version").alias("marked_version"), "once")
    same = F.col(id_name).eqNullSafe(F.col("marked_id")) & (F.col("version") == F.col("marked_version"))
    found = rows.where("doubtful").join(m, same, "left").where("once IS NULL OR once")
    # Rows that stay for other reasons get a number of their own, and so are never copies.
    number = F.when(F.col("once").isNull(), F.monotonically_increasing_id())
    found = found.withColumn("number", number).dropDuplicates([id_name, "version", "number"])
    return rows.where("NOT doubtful").select(*names).unionByName(found.select(*names)).toDF(*docs.columns)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's offsets; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that column ``text`` has about ``limit`` bytes; a longer row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = byte_view(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true bytes; a run ends with its row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(mask), bool)
    before[0] = False
    before[1:] = mask[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(mask))]
    before[edge] = False
    begins = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    after[-1] = False
    after[:-1] = mask[1:]
    after[edge - 1] = False
    return begins, np.flatnonzero(mask & ~after) + 1


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offsets, positions, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


_STEP = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return made_once("hash tables", _make_tables)


def _make_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A code per byte, the powers of an odd step, and those of its inverse."""
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
    rows = []
    for step in (_STEP, pow(_STEP, -1, 1 << 64)):
        powers = np.full(CHUNK_BYTES, step, np.uint64)
        powers[0] = 1
        rows.append(np.multiply.accumulate(powers))
    return codes, rows[0], rows[1]


def _codes(text: np.ndarray) -> np.ndarray:
    """Bytes, or code points, as scattered numbers."""
    if text.dtype == np.uint8:
        return _tables()[0][text]
    return mix((text.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes or code points, from running sums of a polynomial in an odd step.

    Spans come in order and do not overlap. Equal spans have equal hashes wherever they stand.
    """
    _, powers, backs = _tables()
    hashes = np.zeros(len(begins), np.uint64)
    first = 0
    while first < len(begins):
        base = int(begins[first])
        last = max(first + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        text = data[base : ends[last - 1]]
        if len(text) > CHUNK_BYTES:
            value = 0
            for k in range(0, len(text), CHUNK_BYTES):
                part = _codes(text[k : k + CHUNK_BYTES])
                value += int((part * powers[: len(part)]).sum()) * pow(_STEP, k, 1 << 64)
            hashes[first] = value & _ALL
        else:
            total = np.zeros(len(text) + 1, np.uint64)
            np.cumsum(_codes(text) * powers[: len(text)], out=total[1:])
            a, b = begins[first:last] - base, ends[first:last] - base
            hashes[first:last] = (total[b] - total[a]) * backs[a]
        first = last
    return mix(hashes + (ends - begins).astype(np.uint64) * np.uint64(_STEP))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` word hashes, of any row."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(_STEP) + words[k : k + count])
    return total
