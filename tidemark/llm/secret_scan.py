"""Secrets in texts: keyword automaton, anchored expressions near its hits, checksums.

An Aho-Corasick automaton runs once over the bytes of many texts. Expressions are only
tried at its hits. Runs of hex digits have no keyword; as they are long, looking at every
24th byte finds them all. Some tokens carry a CRC-32 of themselves, which is verified.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import byte_view, chunks, made_once

# The kinds in their order, keywords, and least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
PATTERNS = {
    "assign": rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": rb"AKIA[A-Z0-9]+",
    "github": rb"gh[pousr]_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    "npm": rb"npm_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
}
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_fits(token: bytes) -> bool:
    """Whether the last six of ``xxx_`` and 36 characters are the CRC-32 of the 30 before, in base 62."""
    value = 0
    for digit in token[-6:]:
        value = value * 62 + _BASE62.index(digit)
    return value == zlib.crc32(token[-36:-6])


def _tools() -> tuple[ahocorasick.Automaton, dict[str, re.Pattern], np.ndarray]:
    return made_once("secret tools", _make_tools)


def _make_tools() -> tuple[ahocorasick.Automaton, dict[str, re.Pattern], np.ndarray]:
    automaton = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    hex_digit = np.zeros(256, bool)
    hex_digit[list(b"0123456789abcdef")] = True
    return automaton, {k: re.compile(p) for k, p in PATTERNS.items()}, hex_digit


def _accepted(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match.group(1)) >= LEAST_VALUE
    if kind == "access":
        return match.end() - match.start() >= LEAST_ACCESS
    return checksum_fits(match.group())


def find_spans(data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Per row: ``(start, kind, end)`` in bytes of the row, sorted; rows without any are left out."""
    automaton, patterns, hex_digit = _tools()
    raw = data.tobytes()
    found: dict[int, list[tuple[int, int, int]]] = {}
    hits: dict[str, list[int]] = {kind: [] for kind in KEYWORDS}
    for last, (kind, size) in automaton.iter(raw.lower().decode("latin-1")):
        hits[kind].append(last + 1 - size)
    for kind, places in hits.items():
        if not places:
            continue
        places = np.array(places)
        rows = np.searchsorted(offsets, places, "right") - 1
        done = 0
        order = np.argsort(places, kind="stable")
        for row, place in zip(rows[order].tolist(), places[order].tolist()):
            if place < done:
                continue
            match = patterns[kind].match(raw, place, int(offsets[row + 1]))
            if match:
                done = match.end()
                if _accepted(kind, match):
                    base = int(offsets[row])
                    found.setdefault(row, []).append((place - base, KINDS.index(kind), done - base))
    for row, begin, end in _hex_runs(data, offsets, hex_digit, raw):
        found.setdefault(row, []).append((begin, KINDS.index("hex"), end))
    return {row: sorted(spans) for row, spans in found.items()}


def _hex_runs(data, offsets, hex_digit, raw) -> Iterator[tuple[int, int, int]]:
    """Every run of 24 or more covers a byte whose place is 23 modulo 24."""
    probes = np.arange(LEAST_HEX - 1, len(data), LEAST_HEX)
    probes = probes[hex_digit[data[probes]]]
    if not len(probes):
        return
    rows = np.searchsorted(offsets, probes, "right") - 1
    # Most hits are a letter of a word: drop those with another byte close by on both sides.
    near = np.ones(len(probes), bool)
    reach = LEAST_HEX // 2
    before, after = np.ones(len(probes), bool), np.ones(len(probes), bool)
    for step in range(1, reach + 1):
        before &= hex_digit[data[np.maximum(probes - step, 0)]] & (probes - step >= offsets[rows])
        after &= hex_digit[data[np.minimum(probes + step, len(data) - 1)]] & (probes + step < offsets[rows + 1])
        near = before | after
        if not near.any():
            return
    digits, done = re.compile(rb"[0-9a-f]+"), 0
    for row, probe in zip(rows[near].tolist(), probes[near].tolist()):
        if probe < done:
            continue
        base, begin = int(offsets[row]), probe
        while begin > base and hex_digit[data[begin - 1]]:
            begin -= 1
        done = digits.match(raw, begin, int(offsets[row + 1])).end()
        if done - begin >= LEAST_HEX:
            yield row, begin - base, done - base


def code_points(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte places of a UTF-8 text as places in code points."""
    heads = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return heads[places]


def scan_batch(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """Per text: ``(start, kind, end)`` in code points, sorted by start and kind."""
    data, offsets = byte_view(texts)
    found = find_spans(data, offsets)
    result: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for row, spans in found.items():
        text = data[offsets[row] : offsets[row + 1]]
        places = code_points(text, np.array([(s[0], s[2]) for s in spans])).tolist()
        result[row] = [(begin, kind, end) for (begin, end), (_, kind, _) in zip(places, spans)]
    return result


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in spans)


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_assign, n_access, n_hex, base_sha256, spans)``, one row per document.

    ``spans`` lists ``kind:start:end`` by start, then kind, in code points with an
    exclusive end; ``base_sha256`` hashes the list of the first three kinds. Matches of a
    kind are leftmost and do not overlap; those of two kinds may. A null or empty text has
    no spans; repeated rows and null ids are treated like any others.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            per_row = scan_batch(batch.column(1))
            base = [[s for s in spans if s[1] < 3] for spans in per_row]
            counts = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(3)]
            hashes = pa.array([sha256(_joined(spans).encode()).hexdigest() for spans in base])
            columns = [batch.column(0), *counts, hashes, pa.array([_joined(s) for s in per_row], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(id_col, text_col).mapInArrow(
        scan, f"`{id_col}` {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, *, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mask``; overlapping spans become one.

    All columns and rows stay; null texts stay null.
    """
    place = docs.columns.index(text_col)

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, place):
            texts = batch.column(place).to_pylist()
            for row, spans in enumerate(scan_batch(batch.column(place))):
                if spans:
                    texts[row] = _masked(texts[row], spans, mask)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(redact, docs.schema)


def _masked(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    out, done = [], 0
    for begin, _, end in spans:
        if begin >= done:
            out += [text[done:begin], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])
