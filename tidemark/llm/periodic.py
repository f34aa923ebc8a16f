"""Runs: stretches of a text in which the same words come again and again with one period.

Two equal stretches of d words that start q words apart and can be extended to neither
side are a maximal pair. Where q is at most d they touch or overlap, and together are a
stretch of q + d words with period q that no neighbouring word extends, which is a run:
nothing has to be extended afterwards. The pairs come from the tree of LCP intervals
of a text's suffixes, built bottom-up. Every node keeps its suffixes by the word on their left;
where two nodes are joined, suffixes with different words on their left are pairs.

As d is at least half of a run, only suffixes that share that many words with another one
of their text are ordered at all. Texts of a batch are ordered together by arrays.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_view, chunks

#: Words of the shortest run; it has at least two periods, too.
LEAST_RUN = 12
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def number_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, and where each text begins; texts share no numbers, and a mark of its own stands around each."""
    parts, begins, at, used = [], [], 1, 1
    parts.append(np.zeros(1, np.int64))
    for words in texts:
        begins.append(at)
        codes = {word: k for k, word in enumerate(dict.fromkeys(words), used)}
        parts.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
        used += len(codes) + 1
        parts.append(np.array([used - 1]))
        at += len(words) + 1
    return np.concatenate(parts), np.array(begins, np.int64)


def _refined(rank: np.ndarray, places: np.ndarray, step: int) -> np.ndarray:
    """Order places of equal rank by the rank ``step`` on; the places that still share a rank."""
    old, ahead = rank[places], rank[places + step]
    order = np.lexsort((ahead, old))
    places, old, ahead = places[order], old[order], ahead[order]
    group, part = np.ones(len(places), bool), np.ones(len(places), bool)
    group[1:] = old[1:] != old[:-1]
    part[1:] = group[1:] | (ahead[1:] != ahead[:-1])
    index = np.arange(len(places))
    begin = np.maximum.accumulate(np.where(part, index, 0))
    rank[places] = old + begin - np.maximum.accumulate(np.where(group, index, 0))
    counts = np.diff(np.append(np.flatnonzero(part), len(places)))
    return places[np.repeat(counts > 1, counts)]


def suffix_order(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that share ``least`` words with another one, in order: places, common words with the next one, class.

    Ranks of ever longer stretches come from those of shorter ones. Common words are
    counted from the stored ranks, the longest stretches first. A class shares ``least`` words.
    """
    counts = np.bincount(words)
    rank = (np.cumsum(counts) - counts)[words]
    places, depth, levels = np.flatnonzero(counts[words] > 1), 1, []
    while len(places):
        if depth >= least:
            levels.append((depth, places, rank[places]))
        step = min(depth, least - depth) if depth < least else depth
        places, depth = _refined(rank, places, step), depth + step
    if not levels:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, places, kinds = levels[0]
    order = np.argsort(rank[places])
    places, kinds = places[order], kinds[order]
    one, two = places[:-1], places[1:]
    common = np.zeros(len(one), np.int64)
    own = -1 - np.arange(len(words))
    for depth, some, ranks in reversed(levels):
        own[some] = ranks
        common[own[one + common] == own[two + common]] += depth
        own[some] = -1 - some
    same = common >= least
    for _ in range(least - 1):
        same &= words[one + common] == words[two + common]
        common += same
    return places, common, kinds


def _within_reach(places: np.ndarray, common: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the suffixes with another one of their class no further away than the words shared with any."""
    order = np.lexsort((places, kinds))
    gap = np.where(kinds[order][1:] == kinds[order][:-1], np.diff(places[order]), len(places) + int(places.max(initial=0)))
    far = np.full(1, np.iinfo(np.int64).max)
    nearest = np.empty(len(places), np.int64)
    nearest[order] = np.minimum(np.concatenate([far, gap]), np.concatenate([gap, far]))
    none = np.zeros(1, np.int64)
    kept = np.flatnonzero(nearest <= np.maximum(np.concatenate([none, common]), np.concatenate([common, none])))
    if len(kept) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return places[kept], np.minimum.reduceat(common[: kept[-1]], kept[:-1])


class _Node:
    """Suffixes that share some words: all in order, and by the word on their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int) -> None:
        self.places, self.by_left = [place], {left: [place]}

    def near(self, place: int, left: int, depth: int) -> list[int]:
        """Suffixes within ``depth`` words of a place whose left word is another one."""
        low, high = bisect_left(self.places, place - depth), bisect_right(self.places, place + depth)
        if low == high:
            return []
        if high - low <= len(self.by_left):
            own = self.by_left.get(left, ())
            near = self.places[low:high]
            return [p for p in near if not _holds(own, p)] if own else near
        found: list[int] = []
        for word, places in self.by_left.items():
            if word != left:
                found += places[bisect_left(places, place - depth) : bisect_right(places, place + depth)]
        return found

    def add(self, other: _Node) -> None:
        for left, places in other.by_left.items():
            own = self.by_left.setdefault(left, [])
            for place in places:
                insort(own, place)
                insort(self.places, place)


def _holds(places: list[int], place: int) -> bool:
    k = bisect_left(places, place)
    return k < len(places) and places[k] == place


def maximal_pairs(places: list[int], common: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``(place, distance, depth)`` of the maximal pairs that touch or overlap, from suffixes in order.

    ``common`` has the words that each suffix shares with the next. Of two nodes, the
    smaller is looked up in the larger and joined to it.
    """
    stack: list[tuple[int, _Node]] = []

    def joined(one: _Node, two: _Node, depth: int) -> Iterator[tuple[int, int, int]]:
        for word, some in two.by_left.items():
            for place in some:
                for other in one.near(place, word, depth):
                    yield min(place, other), abs(place - other), depth
        one.add(two)

    for place, word, shared in zip(places, left, [*common, 0]):
        node = _Node(place, word)
        while stack and stack[-1][0] >= shared:
            depth, held = stack.pop()
            if len(held.places) < len(node.places):
                held, node = node, held
            yield from joined(held, node, depth)
            node = held
            if depth == shared:
                break
        if shared >= least:
            stack.append((shared, node))


def runs_of(words: np.ndarray, least_run: int = LEAST_RUN) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, sorted. The stretch with a multiple of a run's period is the same run."""
    least = -(-least_run // 2)
    places, common = _within_reach(*suffix_order(words, least))
    found: dict[tuple[int, int], int] = {}
    pairs = maximal_pairs(places.tolist(), common.tolist(), words[places - 1].tolist(), least)
    for start, period, depth in pairs:
        if period + depth >= least_run:
            key = (start, period + depth)
            found[key] = min(period, found.get(key, period))
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_by_text(texts: list[list[bytes]], least_run: int = LEAST_RUN) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each text that has any, by start and period; words are numbered from 0."""
    words, begins = number_words(texts)
    runs = runs_of(words, least_run)
    owners = np.searchsorted(begins, [run[0] for run in runs], "right") - 1
    found: dict[int, list[tuple[int, int, int]]] = {}
    for owner, (start, length, period) in zip(owners.tolist(), runs):
        found.setdefault(owner, []).append((start - int(begins[owner]), length, period))
    return {owner: sorted(some, key=lambda run: (run[0], run[2])) for owner, some in found.items()}


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of repeats: of each run only its first period stays, unless another run repeats it."""
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(kept).tolist()])


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_run: int = LEAST_RUN) -> DataFrame:
    """``(id_col, n_words, runs, collapsed)``, one row per document.

    ``runs`` lists ``(start, length, period)`` by start, then period: stretches of words with
    smallest period ``period``, of at least two periods and ``least_run`` words, that no
    neighbouring word extends. ``collapsed`` has the words that no run repeats, joined
    by one space. Words are runs of characters other than spaces and ASCII controls 9 to 13.
    A null or empty text has no words, no runs and an empty ``collapsed``; null ids and
    repeated rows are like any others, and no other column is read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            data, offsets = byte_view(batch.column(1))
            raw, ends = data.tobytes(), offsets.tolist()
            texts = [raw[begin:end].split() for begin, end in zip(ends, ends[1:])]
            runs = runs_by_text(texts, least_run)
            kept = [collapse(words, runs[k]) if k in runs else b" ".join(words) for k, words in enumerate(texts)]
            flat = [run for k in range(len(texts)) for run in runs.get(k, ())]
            sizes = np.cumsum([0, *(len(runs.get(k, ())) for k in range(len(texts)))])
            fields = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
            columns = [
                batch.column(0),
                pa.array([len(words) for words in texts], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                ),
                pa.array(kept, pa.binary()).view(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "runs", "collapsed"])

    schema = f"`{id_col}` {id_type}, n_words long, runs {_RUNS}, collapsed string"
    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def run_digests(runs: DataFrame) -> DataFrame:
    """``runs`` and ``collapsed`` as numbers and digests: how many, the longest one, and two hashes."""
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS less, r.start AS start, r.period AS period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))))")
    length = -F.col("longest.less")
    others = [c for c in runs.columns if c not in ("n_words", "runs", "collapsed")]
    return runs.withColumn("longest", longest).select(
        *others,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        length.alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def plant_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A tenth of the documents, by the crc32 ``h`` of the id, with their end as copies of a stretch of it.

    With ``g`` = h // 10 and n words, word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + (n - a) // (3 + g % 8). The other documents, and those of null ids, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select(id_col, text_col, F.when(chosen, words).alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    text = F.when(F.col("a").isNotNull(), _repeated()).otherwise(F.col(text_col))
    return rows.select(id_col, text.alias(text_col))


def _repeated() -> Column:
    end = "flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) AS int)))"
    return F.expr(f"array_join(slice(concat(slice(w, 1, a), {end}), 1, n), ' ')")
