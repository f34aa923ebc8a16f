"""Benchmark decontamination as a prefix-filtered containment join.

Every window of an item must be contained in a document whole, so of its shingles the
rarest alone is a necessary one: documents are joined with windows on that shingle only.
Offsets bound where the window can lie, and the words around the shingle decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bit_filter, byte_view, chunks, drop_rows, may_contain, rows_of, runs, span_hashes, stored, window_hashes

#: Words of a window and, at most, of a shingle.
WINDOW = 10
SHINGLE = 5


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words (0-9, a-z, A-Z and all beyond ASCII), and their lower case."""
    word = np.zeros(256, bool)
    word[48:58] = word[65:91] = word[97:123] = True
    word[128:] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return word, lower


class _Words:
    """The words of a batch of texts: places, row and hash of each."""

    def __init__(self, texts: pa.Array) -> None:
        data, offsets = byte_view(texts)
        word, lower = _letters()
        self.data = lower[data]
        self.begins, self.ends = runs(word[data], offsets)
        self.row = rows_of(self.begins, offsets)
        self.hashes = span_hashes(self.data, self.begins, self.ends)
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each shingle of ``size`` words."""
        hashes = window_hashes(self.hashes, size) + np.uint64(size)
        inside = self.row[: len(hashes)] == self.row[size - 1 :][: len(hashes)]
        return hashes[inside].view(np.int64), np.flatnonzero(inside)

    def spelled(self, begin: int, end: int) -> str:
        words = [self.data[a:b].tobytes() for a, b in zip(self.begins[begin:end], self.ends[begin:end])]
        return b" ".join(words).decode()


def _shingle_size(words: int) -> int:
    return min(SHINGLE, words)


def benchmark_windows(benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, words, size, shingles)`` per distinct window of an item; ``shingles`` by offset."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            words = _Words(batch.column(1))
            items, out = batch.column(0).to_pylist(), []
            for k, count in enumerate(words.counts.tolist()):
                size = min(WINDOW, count)
                base = int(words.first[k])
                part = window_hashes(words.hashes[base : base + count], _shingle_size(size)) + np.uint64(_shingle_size(size))
                part = part.view(np.int64)
                for at in range(count - size + 1 if size else 0):
                    shingles = part[at : at + size - _shingle_size(size) + 1].tolist()
                    out.append((items[k], words.spelled(base + at, base + at + size), size, shingles))
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, ["item", "words", "size", "shingles"])

    item = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item")
    rows = benchmark.select(item, F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, words string, size int, shingles array<bigint>").dropDuplicates(["item", "words"])


def _hits(docs: DataFrame, wanted: np.ndarray, sizes: Sequence[int], text_col: str) -> DataFrame:
    """``docs`` without texts, with ``n_words`` and the shingles that pass the filter with words around."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    place = docs.columns.index(text_col)
    kept = [c for c in docs.columns if c != text_col]
    hit = pa.struct([("shingle", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("around", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in chunks(batches, place):
            words = _Words(batch.column(place))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for size in sizes:
                hashes, begins = words.shingles(size)
                passed = np.flatnonzero(may_contain(wanted, hashes))
                reach = WINDOW - size if size == SHINGLE else 0
                for shingle, at in zip(hashes[passed].tolist(), begins[passed].tolist()):
                    row = int(words.row[at])
                    begin = max(at - reach, int(words.first[row]))
                    end = min(at + size + reach, int(words.first[row + 1]))
                    found[row].append(
                        {"shingle": shingle, "place": at - int(words.first[row]), "before": at - begin, "around": words.spelled(begin, end)}
                    )
            columns = [c for k, c in enumerate(batch.columns) if k != place]
            columns += [pa.array(words.counts, pa.int64()), pa.array(found, pa.list_(hit))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "hits"])

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    hits = "array<struct<shingle:bigint,place:bigint,before:int,around:string>>"
    return docs.mapInArrow(scan, f"{schema}, n_words long, hits {hits}")


def _contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str
) -> tuple[DataFrame, DataFrame]:
    """All rows as ``(id, version, n_words)``, and what was found as ``(found, of, n_hit, items)``."""
    windows = stored(benchmark_windows(benchmark, id_col=item_col, text_col=item_text_col), "windows")
    parts = windows.select("words", "size", F.posexplode("shingles").alias("offset", "shingle")).distinct()
    sizes = sorted(_shingle_size(r["size"]) for r in windows.select("size").distinct().collect())
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    scanned = stored(_hits(source, bit_filter(parts, "shingle"), sorted(set(sizes)), "text"), "hits")
    hits = scanned.where(F.size("hits") > 0).select("id", "version", F.explode("hits").alias("hit"))
    hits = hits.select("id", "version", "hit.*")

    # The rarest shingle of a window is its prefix; without any occurrence there is no match.
    seen = hits.groupBy("shingle").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest")
    prefixes = parts.join(seen, "shingle", "left").groupBy("words", "size").agg(rarest)
    prefixes = stored(
        prefixes.where("rarest.n > 0").select("words", "size", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset")),
        "prefixes",
    )
    around = F.split("around", " ")
    begin = F.col("before") - F.col("offset")
    matches = (
        hits.join(prefixes, "shingle")
        .where((begin >= 0) & (begin + F.col("size") <= F.size(around)))
        .where(F.array_join(F.slice(around, begin + 1, F.col("size")), " ") == F.col("words"))
        .select("id", "version", (F.col("place") - F.col("offset")).alias("begin"), "size", "words")
    )
    matches = stored(matches.distinct(), "matches")
    spans = matches.select("id", "version", F.struct("begin", (F.col("begin") + F.col("size")).alias("end")).alias("span"))
    covered = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["begin"], s["end"]))).alias("n"),
            F.greatest(s["end"], x["end"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    hit = spans.groupBy("id", "version").agg(F.collect_set("span").alias("spans")).select("id", "version", covered.alias("n_hit"))
    items = (
        matches.select("id", "version", "words")
        .distinct()
        .join(windows.select("words", "item"), "words")
        .groupBy("id", "version")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    h, i = hit.alias("h"), items.alias("i")
    found = stored(
        h.join(i, F.col("h.id").eqNullSafe(F.col("i.id")) & (F.col("h.version") == F.col("i.version")))
        .select(F.col("h.id").alias("found"), F.col("h.version").alias("of"), "n_hit", "items"),
        "found",
    )
    return scanned.select("id", "version", "n_words"), found


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per document.

    Words are runs of 0-9, A-Z in lower case, a-z and all beyond ASCII. A window is ten
    consecutive words of an item, or all of an item with fewer. ``n_hit`` counts words
    inside an occurrence of any window, ``n_items`` the items with occurring windows, and
    ``items_sha256`` hashes their ids, sorted as strings and joined by commas. Null or
    empty texts have no words and items without words no window; a null item id is listed
    as empty text, a repeated item counts once. Repeated rows each get their result.
    """
    rows, found = _contaminated(docs, benchmark, id_col, text_col, item_col, item_text_col)
    result = rows.join(
        found, F.col("id").eqNullSafe(F.col("found")) & (F.col("version") == F.col("of")), "left"
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    return result.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark; all columns stay."""
    _, found = _contaminated(docs, benchmark, id_col, text_col, item_col, item_text_col)
    keys = found.select(F.col("found").alias("id"), F.col("of").alias("version"), F.lit(False).alias("once"))
    return drop_rows(docs, keys, id_col=id_col, text_col=text_col)
