"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the longest sequence are cut. Pieces are dealt by id hash into
shards of about equal size, which are packed on their own, so no task grows with the
corpus and a lost one is packed again alike. Only ids and lengths are shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Pieces of a shard, about. A shard wastes at most a few bins.
SHARD_PIECES = 8192


@dataclass(frozen=True)
class BinSize:
    """A permitted sequence length and what one such sequence costs."""

    capacity: int
    cost: float


def attention_cost(capacity: int, quadratic: float = 1 / 16384, fixed: float = 64.0) -> BinSize:
    """A cost linear in the length, with a share for attention and one per sequence."""
    return BinSize(capacity, fixed + capacity + quadratic * capacity * capacity)


def pack(lengths: Sequence[int], sizes: Sequence[BinSize]) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each length, and the capacity of each bin; lengths come longest first.

    A piece goes into the open bin, of whatever size, that it leaves the least room in. If
    none has room, the size opens that costs least per unit it can hold of what is left to
    pack. At the end each bin shrinks to the smallest permitted size that holds its contents.
    """
    sizes = sorted(sizes, key=lambda s: s.capacity)
    rooms: list[tuple[int, int]] = []
    bins, places, used = [], [], []
    left = sum(lengths)
    for length in lengths:
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, chosen = rooms.pop(at)
        else:
            fitting = [s for s in sizes if s.capacity >= length]
            room = min(fitting, key=lambda s: (s.cost / min(s.capacity, left), s.capacity)).capacity
            chosen = len(used)
            used.append(0)
        bins.append(chosen)
        places.append(used[chosen])
        used[chosen] += length
        left -= length
        if room > length:
            insort(rooms, (room - length, chosen))
    capacities = [next(s.capacity for s in sizes if s.capacity >= u) for u in used]
    return bins, places, capacities


def pack_documents(
    docs: DataFrame, length: Column, sizes: Sequence[BinSize], *, id_col: str = "doc_id", shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``(id_col, piece, start, length, bin, place, capacity)``, one row per piece.

    Every unit of every document lies in exactly one piece: pieces of the largest capacity,
    then the rest. ``bin`` is unique, ``place`` is the piece's start in it. A document of
    length null or zero is one piece of length 0 without a bin. Repeated rows are packed
    each; a null id is dealt like others. The result does not depend on the order of rows.
    """
    if not sizes:
        raise ValueError("at least one permitted length is needed")
    most = max(s.capacity for s in sizes)
    zero = F.lit(0).cast("long")
    total = F.greatest(F.coalesce(length.cast("long"), zero), zero)
    begins = F.sequence(zero, F.greatest(F.col("total") - 1, zero), F.lit(most).cast("long"))
    pieces = (
        docs.select(F.col(id_col), total.alias("total"))
        .select(id_col, "total", F.posexplode(begins).alias("piece", "start"))
        .select(id_col, F.col("piece").cast("long").alias("piece"), "start", F.least(F.lit(most), F.col("total") - F.col("start")).alias("length"))
    )
    keys = [id_col, "piece", "start", "length"]
    counted = stored(pieces.groupBy(*keys).agg(F.count("*").alias("copies")), "pieces")
    some = counted.where("length > 0")
    count = some.agg(F.coalesce(F.sum("copies"), zero)).first()[0]
    shards = max(1, -(-count // shard_pieces))
    # Copies of a piece are dealt in lots, so that a repeated row fills no shard alone.
    lot = max(1, shard_pieces // 8)
    lots = some.withColumn("lot", F.explode(F.sequence(zero, F.expr(f"(copies - 1) div {lot}")))).withColumn(
        "copies", F.least(F.lit(lot), F.col("copies") - F.col("lot") * lot)
    )
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    dealt = lots.withColumn("shard", F.pmod(F.xxhash64(named, "piece", "length", "lot"), F.lit(shards)))
    id_type = docs.schema[id_col].dataType.simpleString()

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), (id_col, "ascending"), ("piece", "ascending"), ("lot", "ascending")])
        rows = rows.select(keys).take(pa.array(np.repeat(np.arange(len(rows)), rows["copies"].to_numpy())))
        bins, places, capacities = pack(rows["length"].to_pylist(), sizes)
        numbers = np.array(bins, np.int64)
        return (
            rows.append_column("bin", pa.array((numbers << 32) + key[0].as_py()))
            .append_column("place", pa.array(places, pa.int64()))
            .append_column("capacity", pa.array(np.array(capacities, np.int64)[numbers]))
        )

    filled = dealt.groupBy("shard").applyInArrow(
        fill, f"`{id_col}` {id_type}, piece long, start long, length long, bin long, place long, capacity long"
    )
    empty = counted.where("length = 0").select(*keys, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    nothing = [F.lit(None).cast("long").alias(name) for name in ("bin", "place", "capacity")]
    return filled.unionByName(empty.select(*keys, *nothing))


def word_count(text: Column) -> Column:
    """The number of runs of characters other than spaces and ASCII controls 9 to 13; null has none."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))
