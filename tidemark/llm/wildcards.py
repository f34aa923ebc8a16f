"""URL rules as globs, matched all at once by a bit-parallel wildcard automaton.

The elements of all globs are the bits of one long state, kept in 64-bit words. A
character moves every state on by a shift and a mask (Shift-And); a wildcard is a
state that also keeps itself alive. One step handles all globs on all URLs of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_view, lower_ascii

#: State words that a task holds at a time.
STATE_WORDS = 1 << 20
_SLASH = ord("/")


@dataclass(frozen=True)
class UrlRule:
    """``glob`` over host and path: ``?`` is a byte and ``*`` any run without a slash, ``**`` any run.

    ``label`` is what the result names the rule; without one it only gives the verdict.
    Of the rules that fit, the one with the longest label wins, then the longest glob,
    then blocking.
    """

    action: str
    glob: str
    label: str | None = None


def prefix_rules(action: str, rule: str) -> list[UrlRule]:
    """``host/path`` for the host and its subdomains, and paths that begin so."""
    return [UrlRule(action, f"{rule}**", rule), UrlRule(action, f"*.{rule}**", rule)]


class Automaton:
    """Masks of all globs: which bytes enter a state, and which ones keep it."""

    def __init__(self, globs: Sequence[str]) -> None:
        states: list[tuple[np.ndarray, np.ndarray]] = []
        starts, ends = [], []
        for glob in globs:
            starts.append(len(states))
            enter, keep = np.zeros(256, bool), np.zeros(256, bool)
            left = glob.encode()
            while left:
                if left.startswith(b"**"):
                    keep = np.ones(256, bool)
                    left = left[2:]
                elif left.startswith(b"*"):
                    keep = keep | (np.arange(256) != _SLASH)
                    left = left[1:]
                else:
                    states.append((enter, keep))
                    any_byte = left.startswith(b"?")
                    enter = np.arange(256) != _SLASH if any_byte else np.arange(256) == left[0]
                    keep = np.zeros(256, bool)
                    left = left[1:]
            states.append((enter, keep))
            ends.append(len(states) - 1)
        self.width = (len(states) + 63) // 64 or 1
        self.start = self._pack(np.isin(np.arange(len(states)), starts)[None, :])[0]
        blank = np.zeros((256, 0), bool)
        self.enter = self._pack(np.stack([s[0] for s in states], axis=1) if states else blank)
        self.keep = self._pack(np.stack([s[1] for s in states], axis=1) if states else blank)
        self.ends = np.array(ends, np.int64)

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits), self.width * 64), bool)
        padded[:, : bits.shape[1]] = bits
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per row and glob: whether the glob fits the whole row."""
        lengths = np.diff(offsets)
        found = np.zeros((len(lengths), len(self.ends)), bool)
        order = np.argsort(-lengths, kind="stable")
        rows = max(1, STATE_WORDS // self.width)
        for begin in range(0, len(order), rows):
            part = order[begin : begin + rows]
            found[part] = self._run(data, offsets[part], lengths[part])
        return found

    def _run(self, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Rows come longest first, so those that go on are a prefix."""
        state = np.repeat(self.start[None, :], len(begins), axis=0)
        falling = -lengths
        for step in range(int(lengths[0]) if len(lengths) else 0):
            alive = int(np.searchsorted(falling, -step, "left"))
            now = state[:alive]
            if alive == 1 and not now.any():
                break
            byte = data[begins[:alive] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.enter[byte]
            moved |= now & self.keep[byte]
            state[:alive] = moved
        word, bit = self.ends // 64, (self.ends % 64).astype(np.uint64)
        return (state[:, word] >> bit & np.uint64(1)).astype(bool)


def judge_urls(
    urls: DataFrame,
    rules: Sequence[UrlRule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, glob)``, one row per row of ``urls``.

    The host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    with A-Z in lower case; the path follows up to ``?``, ``#`` or the end. Without
    ``://``, or for null, both are empty, which only globs of wildcards fit. A rule with a
    label beats all rules without one. ``glob`` is the glob that decided; where no rule
    fits, ``rule`` and ``glob`` are null and the verdict is ``default``. Repeated rows and
    null ids are judged like any others.
    """
    mark = F.instr(F.col(url_col), "://")
    rest = F.when(mark > 0, F.col(url_col).substr(mark + 3, F.length(url_col))).otherwise("")
    parts = (
        urls.select(F.col(id_col), F.coalesce(rest, F.lit("")).alias("rest"))
        .select(id_col, "rest", F.regexp_extract("rest", "^[^/?#]*", 0).alias("host"))
        .select(
            id_col,
            lower_ascii(F.col("host")).alias("host"),
            F.regexp_extract(F.col("rest").substr(F.length("host") + 1, F.length("rest")), "^[^?#]*", 0).alias("path"),
        )
    )
    ranked = sorted(rules, key=lambda r: (r.label is None, -len(r.label or ""), -len(r.glob), r.action != "block"))
    automaton = Automaton([r.glob for r in ranked])
    pick = {
        "rule": pa.array([r.label for r in ranked] + [None], pa.string()),
        "verdict": pa.array([r.action for r in ranked] + [default], pa.string()),
        "glob": pa.array([r.glob for r in ranked] + [None], pa.string()),
    }
    id_type = urls.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            canonical = pa.array([h + p for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], pa.string())
            fits = automaton.matches(*byte_view(canonical))
            last = np.ones((len(fits), 1), bool)
            first = pa.array(np.concatenate([fits, last], axis=1).argmax(axis=1))
            columns = [batch.column(0), batch.column(1), batch.column(2), *(v.take(first) for v in pick.values())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "host", "path", *pick])

    return parts.mapInArrow(judge, f"`{id_col}` {id_type}, host string, path string, rule string, verdict string, glob string")
