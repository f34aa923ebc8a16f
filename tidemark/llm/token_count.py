"""Exact token counts by byte-pair merging of whole batches in ragged arrays.

Texts are cut into pre-tokens with array operations. The distinct ones of a batch lie in
one flat array of symbols; each round every sequence applies its lowest-ranked pair, at
all its places, to all sequences at once. Counts of pre-tokens are kept in the task for
later batches, up to a bound.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import byte_view, chunks, span_hashes, shared_value

#: Pre-tokens whose counts a task remembers; beyond it the memory starts anew.
REMEMBERED = 1 << 20
#: Sequences with more symbols are merged one by one with a heap, in n log n.
LONG = 1024
_NONE = np.int32(2**31 - 1)

# Fixed values of the tokenizer's format: white space, contractions, and the parts it must have.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@dataclass(frozen=True)
class MergeTable:
    """Ids of first symbols by byte, inside and at the end of a pre-token; pairs with rank and result."""

    inner: np.ndarray
    final: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    specials: tuple[str, ...]
    #: Kind and lower-case form of every code point.
    kinds: np.ndarray
    lower: np.ndarray


def _byte_letters() -> list[str]:
    """Printable bytes stand for themselves, the others for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def read_merges(path: str) -> MergeTable:
    """The merges of a word-end BPE vocabulary file; other kinds of tokenizer are refused."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, steps = spec["model"], (spec["normalizer"] or {}).get("normalizers")
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    if (
        model.get("end_of_word_suffix") != "</w>"
        or steps != _STEPS
        or [s.get("type") for s in split] != ["Split", "ByteLevel"]
        or split[0]["pattern"] != {"Regex": _SPLIT}
        or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    ):
        raise ValueError(f"{path} is not a word-end BPE tokenizer of the known form")
    vocab, letters = model["vocab"], _byte_letters()
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
    results = np.array([vocab[a + b] for a, b in merges], np.int32)
    order = np.argsort(pairs, kind="stable")
    return MergeTable(
        np.array([vocab[c] for c in letters], np.int32),
        np.array([vocab[c + "</w>"] for c in letters], np.int32),
        pairs[order],
        order.astype(np.int32),
        results[order],
        tuple(t["content"] for t in spec["added_tokens"]),
        *_characters(),
    )


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case form of every code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = _LETTER
        elif major == "N":
            kinds[point] = _NUMBER
        small = chr(point).lower()
        if len(small) == 1:
            lower[point] = ord(small)
    kinds[[ord(c) for c in _SPACES]] = _SPACE
    return kinds, lower


def pre_tokens(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pre-tokens in rows of lower-cased code points."""
    kinds = kinds[points]
    heads = np.zeros(len(points) + 1, bool)
    heads[offsets] = True
    heads = heads[:-1]
    change = np.ones(len(points), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    starts = (change | heads | (kinds == _NUMBER)) & (kinds != _SPACE)
    quotes = np.flatnonzero((points == ord("'")) & starts)
    if len(quotes):
        limit = offsets[np.searchsorted(offsets, quotes, "right")]
        for ending in _ENDINGS:
            fits = quotes + len(ending) < limit
            for k, letter in enumerate(ending, 1):
                fits &= points[np.minimum(quotes + k, len(points) - 1)] == ord(letter)
            starts[quotes[fits] + 1] = False
            after = quotes[fits] + len(ending) + 1
            after = after[after < limit[fits]]
            starts[after] |= kinds[after] == _LETTER
    edges = np.flatnonzero(starts | heads | (kinds == _SPACE))
    begins = np.flatnonzero(starts)
    edges = np.append(edges, len(points))
    return begins, edges[np.searchsorted(edges, begins, "right")]


def merge_counts(words: list[bytes], table: MergeTable) -> np.ndarray:
    """The number of symbols left of each pre-token when no pair can be merged."""
    counts = np.zeros(len(words), np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    for k in np.flatnonzero(lengths > LONG):
        counts[k] = _merge_long(_symbols(np.frombuffer(words[k], np.uint8), np.array([lengths[k]]), table), table)
    short = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    if len(short):
        data = np.frombuffer(b"".join([words[k] for k in short]), np.uint8)
        counts[short] = _merge_together(_symbols(data, lengths[short], table), lengths[short], table)
    return counts


def _symbols(data: np.ndarray, lengths: np.ndarray, table: MergeTable) -> np.ndarray:
    symbols = table.inner[data]
    last = np.cumsum(lengths) - 1
    symbols[last] = table.final[data[last]]
    return symbols


def _ranks(left: np.ndarray, right: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """Rank (or none) and place in the table of each pair of symbols."""
    keys = left.astype(np.int64) << 32 | right
    place = np.minimum(np.searchsorted(table.pairs, keys), len(table.pairs) - 1)
    return np.where(table.pairs[place] == keys, table.ranks[place], _NONE), place


def _merge_together(symbols: np.ndarray, lengths: np.ndarray, table: MergeTable) -> np.ndarray:
    counts = lengths.copy()
    owner = np.repeat(np.arange(len(lengths)), lengths)
    while len(symbols) > 1:
        ranks, place = _ranks(symbols[:-1], symbols[1:], table)
        ranks[owner[:-1] != owner[1:]] = _NONE
        ranks = np.append(ranks, _NONE)
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(heads, len(owner)))
        least = np.minimum.reduceat(ranks, heads)
        counts[owner[heads]] = sizes
        going = np.repeat(least != _NONE, sizes)
        if not going.any():
            break
        chosen = (ranks == np.repeat(least, sizes)) & going
        # Of pairs that overlap, as in "aaa", every second one from the left is merged.
        spots = np.flatnonzero(chosen)
        fresh = np.append(True, np.diff(spots) > 1)
        since = np.arange(len(spots)) - np.maximum.accumulate(np.where(fresh, np.arange(len(spots)), 0))
        spots = spots[since % 2 == 0]
        symbols[spots] = table.results[place[spots]]
        keep = going
        keep[spots + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    else:
        counts[owner] = 1
    return counts


def _merge_long(symbols: np.ndarray, table: MergeTable) -> int:
    """One long sequence: a heap of pairs by rank and place over a linked list."""
    ranks, place = _ranks(symbols[:-1], symbols[1:], table)
    some = np.flatnonzero(ranks != _NONE)
    heap = list(zip(ranks[some].tolist(), some.tolist(), table.pairs[place[some]].tolist()))
    heapq.heapify(heap)
    known = dict(zip(table.pairs.tolist(), zip(table.ranks.tolist(), table.results.tolist())))
    current = symbols.tolist()
    size = len(current)
    following, previous = list(range(1, size + 1)), list(range(-1, size - 1))
    left = size
    while heap:
        _, at, pair = heapq.heappop(heap)
        after = following[at]
        if current[at] < 0 or after >= size or current[at] << 32 | current[after] != pair:
            continue
        current[at], current[after] = known[pair][1], -1
        following[at] = following[after]
        if following[at] < size:
            previous[following[at]] = at
        left -= 1
        for begin in (previous[at], at):
            end = following[begin] if begin >= 0 else size
            if begin >= 0 and end < size:
                key = current[begin] << 32 | current[end]
                if key in known:
                    heapq.heappush(heap, (known[key][0], begin, key))
    return left


class Counter:
    """Counts tokens of Arrow string columns, remembering pre-tokens by their 64-bit hash."""

    def __init__(self, table: MergeTable) -> None:
        self.table = table
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, texts: pa.Array) -> np.ndarray:
        data, offsets = byte_view(texts)
        totals = np.zeros(len(texts), np.int64)
        if not len(data):
            return totals
        whole = data.tobytes()
        if any(s.encode() in whole for s in self.table.specials) or not whole.isascii():
            points, offsets = self._unicode(texts, totals)
        else:
            points = self.table.lower[data]
        if not len(points):
            return totals
        begins, ends = pre_tokens(points, offsets, self.table.kinds)
        hashes = span_hashes(points, begins, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        counts = self._counts(distinct, points, begins[first], ends[first])[inverse]
        rows = np.searchsorted(offsets, begins, "right") - 1
        return totals + np.bincount(rows, counts, len(totals)).astype(np.int64)

    def _unicode(self, texts: pa.Array, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points, normalised and in lower case; special strings are counted and cut out."""
        strings = [t or "" for t in texts.to_pylist()]
        for special in self.table.specials:
            for row, text in enumerate(strings):
                if special in text:
                    totals[row] += text.count(special)
                    strings[row] = text.replace(special, "\n")
        strings = [t if t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in strings]
        strings = [t.replace("İ", "i̇") if "İ" in t else t for t in strings]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in strings])]).astype(np.int64)
        points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        return self.table.lower[points], offsets

    def _counts(self, distinct: np.ndarray, points: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(distinct):
            return np.zeros(0, np.int64)
        place = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == distinct[inside]
        counts = np.zeros(len(distinct), np.int64)
        counts[known] = self.counts[place[known]]
        new = np.flatnonzero(~known)
        words = [points[a:b].tobytes().decode("utf-32-le").encode() for a, b in zip(begins[new].tolist(), ends[new].tolist())]
        counts[new] = merge_counts(words, self.table)
        if len(self.hashes) + len(new) > REMEMBERED:
            self.hashes, self.counts = distinct[new], counts[new]
        else:
            self.hashes = np.insert(self.hashes, place[new], distinct[new])
            self.counts = np.insert(self.counts, place[new], counts[new])
        return counts


def count_tokens(
    docs: DataFrame, tokenizer_path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)``, one row per document.

    ``n_bytes`` counts UTF-8 bytes, ``n_tokens`` the tokens of the whole text without
    begin, end or added ones; a special token's string counts as that token. Null and
    empty texts have none. Repeated rows and null ids are counted like any others. The
    vocabulary file is read on the driver and travels with the tasks; its size is fixed.
    """
    table = shared_value(docs.sparkSession, read_merges(tokenizer_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(table())
        for batch in chunks(batches, 1):
            tokens = counter.count(batch.column(1))
            sizes = np.diff(byte_view(batch.column(1))[1])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean")
