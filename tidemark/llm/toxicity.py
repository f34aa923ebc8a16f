"""Toxicity scores of restored text: a noisy channel undoes leetspeak, spacing and repetition.

A character trigram model is counted over all documents. Words that may be read in
several ways become lattices: a digit or symbol may stand for letters or for a break, a run
of a letter for one or two, a sign within a word or a gap between single letters for nothing. A Viterbi search under the model picks the likeliest
reading. Words and beginnings of words of the restored texts are then scored by how often
their documents are labelled toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_view, chunks, drawn, runs, share_of, shared_value, stored

# What digits and symbols may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
#: Costs, in nats, of reading a sign as a letter or as a break, a run as one letter, and of dropping a gap.
LEET_COST, WILD_COST, BREAK_COST, RUN_COST, GAP_COST = 1.0, 2.5, 4.0, 0.5, 0.3
#: Signs after which what all paths share is written out, and copies of a symbol that count.
LATTICE = 64
#: Labelled texts that enter the training, about; and the least share and count of a feature.
TRAINING_TEXTS = 20_000
LEAST_SHARE, LEAST_TEXTS, PRIOR_TEXTS = 0.5, 8, 3.0
#: Lengths in bytes of the beginnings of words that are features beside whole words.
PREFIXES = (5, 6, 7, 8)
#: Readings that a task remembers.
REMEMBERED = 50_000
_SYMBOLS = 28  # a boundary, a to z, and any byte beyond ASCII


def _tables() -> dict[str, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    digit = np.zeros(256, bool)
    digit[48:58] = True
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in LEET if not c.isdigit()]] = True
    gap = np.zeros(256, bool)
    gap[[ord(c) for c in " .-_"]] = True
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    code = np.zeros(256, np.int64)
    code[97:123] = np.arange(1, 27)
    code[128:] = 27
    return {"lower": lower, "letter": letter, "digit": digit, "symbol": symbol, "gap": gap, "blank": blank, "code": code}


_T = _tables()
_SYMBOL = re.compile(b"[" + re.escape("".join(c for c in LEET if not c.isdigit()).encode()) + b"]")
#: Signs of several readings, with fewer than two plain letters between.
_AMBIGUOUS = re.compile(rb"(?:([a-z])\1+|[^a-z\x80-\xff])(?:[a-z\x80-\xff]?(?:([a-z])\2+|[^a-z\x80-\xff]))*")
#: Letters with a symbol, digit or blank between.
_PIECES = re.compile(rb"[a-z\x80-\xff][^a-z\x80-\xff]*[0-9\s" + _SYMBOL.pattern[1:] + rb"[^a-z\x80-\xff]*[a-z\x80-\xff]")
_CODES = _T["code"].tolist()
_LETTERS = np.where(_T["letter"], np.arange(256), 32).astype(np.uint8).tobytes()


def count_trigrams(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often each character follows two others, over all texts; a word starts from boundaries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, np.int64)
        for batch in chunks(batches, 0):
            data, offsets = byte_view(batch.column(0))
            codes = _T["code"][_T["lower"][data]]
            padded = np.zeros(len(codes) + 2 * len(offsets), np.int64)
            padded[np.arange(len(codes)) + 2 * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = codes
            a, b, c = padded[:-2], padded[1:-1], padded[2:]
            gram = np.where(b == 0, 0, a) * _SYMBOLS**2 + b * _SYMBOLS + c
            total += np.bincount(gram[(b > 0) | (c > 0)], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], names=["gram", "n"])

    rows = docs.select(text_col).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(_SYMBOLS**3, np.int64)
    counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)


def surprise(counts: np.ndarray) -> list[float]:
    """The negative log probability of each trigram's end, smoothed by shorter contexts."""
    ones = counts.sum(axis=(0, 1)) + 1.0
    ones = ones / ones.sum()
    twos = counts.sum(axis=0) + 5 * ones
    twos = twos / twos.sum(axis=1, keepdims=True)
    threes = counts + 5 * twos
    threes = threes / threes.sum(axis=2, keepdims=True)
    return (-np.log(threes)).reshape(-1).tolist()


def disguised(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of lower-cased texts that may hide a word, in order and apart from each other.

    These are the words whose lattice has more than one path, without the signs around
    them, and single letters with gaps between. A word of under three signs that may be
    letters is no feature, and one without a letter is a number or a rule.
    """
    if not len(data):
        return []
    letter, digit, symbol = _T["letter"][data], _T["digit"][data], _T["symbol"][data]
    heads = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros(len(data), bool)
    before[1:] = letter[:-1]
    before[heads] = False
    double = np.zeros(len(data), bool)
    double[1:] = letter[1:] & (data[1:] == data[:-1]) & (data[1:] < 128)
    begins, ends = runs(~_T["blank"][data], offsets)
    double[begins] = False
    core = np.flatnonzero(letter | digit)

    def within(mask: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[highs] - sums[lows]

    some = within(letter, begins, ends) > 0
    begins, ends = begins[some], ends[some]
    firsts, lasts = core[np.searchsorted(core, begins)], core[np.searchsorted(core, ends) - 1] + 1
    signs = within(letter | digit | symbol, begins, ends) >= 3
    paths = (within(digit | symbol | double, begins, ends) > 0) | (within(~letter, firsts, lasts) > 0)
    spans = list(zip(firsts[signs & paths].tolist(), lasts[signs & paths].tolist()))
    return _apart(spans + _spaced(data, offsets, letter | digit | symbol, letter, before))


def _spaced(data, offsets, sign, letter, before) -> list[tuple[int, int]]:
    """Three or more single letters with one gap between each."""
    gap = _T["gap"][data]
    heads = offsets[:-1][np.diff(offsets) > 0]
    sign_before, sign_after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    sign_before[1:], sign_after[:-1] = sign[:-1], sign[1:]
    sign_before[heads] = False
    sign_after[heads[1:] - 1] = False
    single = sign & ~sign_before & ~sign_after & (data < 128)
    step = np.zeros(len(data), bool)
    step[:-2] = single[:-2] & gap[1:-1] & single[2:]
    row = np.searchsorted(offsets, np.flatnonzero(step), "right")
    places = np.flatnonzero(step)
    places = places[places + 2 < offsets[row]]
    spans, k = [], 0
    places = places.tolist()
    while k < len(places):
        last = k
        while last + 1 < len(places) and places[last + 1] == places[last] + 2:
            last += 1
        if last > k and letter[places[k] : places[last] + 3].sum() >= 2:
            spans.append((places[k], places[last] + 3))
        k = last + 1
    return spans


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for begin, end in sorted(s for s in spans if s[1] > s[0]):
        if joined and begin < joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((begin, end))
    return joined


def _signs(span: bytes) -> list[tuple[tuple[str, float], ...]]:
    """Per sign of a span, its readings with their costs; an empty reading drops it."""
    signs: list[tuple[tuple[str, float], ...]] = []
    k = 0
    while k < len(span):
        char, end = chr(span[k]), k + 1
        while end < len(span) and span[end] == span[k]:
            end += 1
        if char in LEET:
            cost = WILD_COST if char == "*" else LEET_COST
            signs += [(*((c, cost) for c in LEET[char]), (" ", BREAK_COST))] * (end - k)
        elif span[k] >= 128:
            signs += [((char, 0.0),)] * (end - k)
        elif char.isalpha():
            if end - k == 1:
                signs.append(((char, 0.0),))
            else:
                signs.append(((char, RUN_COST), (char * 2, 0.0 if end - k == 2 else RUN_COST)))
        else:
            signs.append(((" ", 0.0), ("", GAP_COST)))
        k = end
    return signs


def _step(states: dict, readings: Sequence[tuple[str, float]], model: Sequence[float]) -> dict:
    """The least cost and the path of each state after a sign."""
    following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
    for (a, b), (cost, path) in states.items():
        for text, price in readings:
            x, y, total = a, b, cost + price
            for char in text:
                z = _CODES[ord(char)]
                if y or z:
                    total += model[((x if y else 0) * _SYMBOLS + y) * _SYMBOLS + z]
                x, y = (y, z) if z else (0, 0)
            if (x, y) not in following or total < following[x, y][0]:
                following[x, y] = (total, (path, text))
    return following


def _parts(path: tuple | None) -> list[str]:
    parts = []
    while path:
        parts.append(path[1])
        path = path[0]
    return parts[::-1]


def _walk(states: dict, signs: Sequence, model: Sequence[float]) -> dict:
    """The states after a number of signs."""
    for readings in signs:
        states = _step(states, readings, model)
    return states


def _settle(states: dict) -> tuple[list[str], dict, int]:
    """The readings that all paths begin with, the states without them, and the signs left."""
    paths = {state: _parts(path) for state, (_, path) in states.items()}
    first, *others = paths.values()
    shared = next((k for k in range(len(first)) if any(path[k] != first[k] for path in others)), len(first))
    left = {}
    for state, parts in paths.items():
        path = None
        for text in parts[shared:]:
            path = (path, text)
        left[state] = (states[state][0], path)
    return first[:shared], left, len(first) - shared


def _read(states: dict, signs: Sequence, model: Sequence[float]) -> tuple[list[str], dict]:
    """The readings that are sure after a number of signs, and the states with the paths behind those.

    States are carried through all signs; what all their paths share is written out
    whenever as many signs again have been read as were left open.
    """
    out, begin, size = [], 0, LATTICE
    while begin < len(signs):
        states = _walk(states, signs[begin : begin + size], model)
        begin += size
        if begin < len(signs):
            settled, states, left = _settle(states)
            out += settled
            size = max(LATTICE, left)
    return out, states


def read_span(span: bytes, model: Sequence[float]) -> str:
    """The likeliest text behind a span; bytes beyond ASCII stand as Latin-1 characters."""
    out, states = _read({(0, 0): (0.0, None)}, [*_signs(span), ((" ", 0.0),)], model)
    return "".join(out + _parts(min(states.values(), key=lambda s: s[0])[1]))


def _edge(span: bytes) -> list[tuple[int, tuple]]:
    """Runs of equal signs around a word, with the readings of each sign; a symbol is no break here."""
    found, k = [], 0
    while k < len(span):
        end = k + 1
        while end < len(span) and span[end] == span[k]:
            end += 1
        symbol = bool(_T["symbol"][span[k]])
        readings = _signs(span[k : k + 1])[0]
        found.append((min(end - k, LATTICE), readings[:-1]) if symbol else (1, readings))
        k = end
    return found


class Restorer:
    """Restores batches of texts; readings of spans are remembered."""

    def __init__(self, model: Sequence[float]) -> None:
        self.model, self.known, self.parts = model, {}, {}
        self.cube, self.leads, self.trails = np.array(model, float).reshape((_SYMBOLS,) * 3), {}, {}
        self.cube[0, 0, 0] = 0

    def restore(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[tuple[int, str]]]:
        """Lower-cased texts, their offsets, and what disguised spans read, by row.

        Spans in pieces, with signs between letters, are blanked in the texts. Other
        words stay, and only words that they do not have themselves are readings.
        """
        data, offsets = byte_view(texts)
        data = _T["lower"][data]
        raw, readings = data.tobytes(), []
        spans = np.array(disguised(data, offsets), np.int64).reshape(-1, 2)
        rows = np.searchsorted(offsets, spans[:, 0], "right") - 1
        begins, ends = runs(~_T["blank"][data], offsets)
        lows = begins[np.searchsorted(begins, spans[:, 0], "right") - 1] if len(spans) else spans[:, 0]
        highs = ends[np.searchsorted(ends, spans[:, 1])] if len(spans) else spans[:, 1]
        for row, low, begin, end, high in zip(rows.tolist(), lows.tolist(), spans[:, 0].tolist(), spans[:, 1].tolist(), highs.tolist()):
            key = raw[low:high]
            known = self.known.get(key)
            if known is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                known = self.known[key] = self.read(raw[low:begin], raw[begin:end], raw[end:high])
            text, pieces = known
            if text:
                readings.append((row, text))
            if pieces:
                data[begin:end] = 32
        return data, offsets, readings

    def read(self, lead: bytes, core: bytes, trail: bytes) -> tuple[str, bool]:
        """What a span reads, with the symbols around it dropped and as letters; and whether it is in pieces."""
        pieces = bool(_PIECES.search(core)) or _single(core)
        plain, text = core.decode("latin-1"), self.read_parts(b"", core, b"")
        texts = [text] if pieces or text != plain else []
        heads, tails = ((b"", edge) if edge and _SYMBOL.search(edge) else (b"",) for edge in (lead, trail))
        texts += [self.read_parts(head, core, tail) for head in heads for tail in tails if head or tail]
        seen = set() if pieces or not texts else set(_words(plain))
        words = []
        for text in texts:
            new = [word for word in _words(text) if word not in seen]
            words += new
            seen.update(new)
        return " ".join(words), pieces

    def read_parts(self, lead: bytes, core: bytes, trail: bytes) -> str:
        """The likeliest text of a span, whose ambiguous parts are read apart where two plain letters part them.

        After two letters that have one reading there is one state, so this is the reading
        of the whole span.
        """
        places = [(0, 0)] * bool(lead) + [m.span() for m in _AMBIGUOUS.finditer(core)] + [(len(core),) * 2] * bool(trail)
        parts: list[list[int]] = []
        for begin, end in places:
            if parts and begin - parts[-1][1] < 2:
                parts[-1][1] = end
            else:
                parts.append([begin, end])
        out, done = [], 0
        for begin, end in parts:
            close = min(end + 2, len(core))
            out.append(core[done:begin].decode("latin-1"))
            key = (
                core[max(0, begin - 2) : begin], core[begin:close], close < end + 2,
                lead if not begin else b"", trail if end == len(core) else b"",
            )
            text = self.parts.get(key)
            if text is None:
                if len(self.parts) >= REMEMBERED:
                    self.parts.clear()
                text = self.parts[key] = self._read_part(*key)
            out.append(text)
            done = close
        return "".join(out) + core[done:].decode("latin-1")

    def _read_part(self, context: bytes, part: bytes, last: bool, lead: bytes, trail: bytes) -> str:
        state = (0, 0, *(_CODES[c] for c in context))[-2:]
        out, states = _read(self._lead(lead) if lead else {state: (0.0, None)}, _signs(part), self.model)
        end = self._end(states, trail) if last else "".join(_parts(min(states.values(), key=lambda s: s[0])[1]))
        return "".join(out) + end

    def _lead(self, lead: bytes) -> dict:
        """The states after the signs before a word; the run next to the word is read, others may be dropped."""
        if lead not in self.leads:
            if len(self.leads) >= REMEMBERED // 50:
                self.leads.clear()
            states, signs = {(0, 0): (0.0, None)}, _edge(lead)
            nearest = max(k for k, (_, readings) in enumerate(signs) if readings[0][0] != " ")
            for k, (count, readings) in enumerate(signs):
                read = _walk(states, [readings] * count, self.model)
                if k != nearest and readings[0][0] != " ":
                    for state, (cost, path) in states.items():
                        if state not in read or cost + LEET_COST < read[state][0]:
                            read[state] = (cost + LEET_COST, path)
                states = read
            self.leads[lead] = states
        return self.leads[lead]

    def _trail(self, trail: bytes) -> tuple[np.ndarray, list]:
        """By state, the least cost of the signs after a word; the run next to it is read, others may be dropped.

        With it, per run: how many signs, their readings, where to drop it, and which reading
        each sign takes.
        """
        if trail not in self.trails:
            if len(self.trails) >= REMEMBERED // 50:
                self.trails.clear()
            cost, steps, signs = self.cube[:, :, 0], [], _edge(trail)
            nearest = min((k for k, (_, readings) in enumerate(signs) if readings[0][0] != " "), default=0)
            for k in range(len(signs) - 1, -1, -1):
                count, readings = signs[k]
                rest, choices = cost, []
                for _ in range(count):
                    options = np.stack([self._before(text, price, cost) for text, price in readings])
                    choices.append(options.argmin(axis=0).astype(np.int8))
                    cost = options.min(axis=0)
                dropped = np.zeros(cost.shape, bool)
                if k != nearest and readings[0][0] != " ":
                    dropped = rest + LEET_COST < cost
                    cost = np.where(dropped, rest + LEET_COST, cost)
                steps.append((readings, dropped, choices[::-1]))
            self.trails[trail] = cost, steps[::-1]
        return self.trails[trail]

    def _before(self, text: str, price: float, cost: np.ndarray) -> np.ndarray:
        """By state, the cost of one reading and what follows it."""
        if not text:
            return cost + price
        z = _CODES[ord(text)]
        return self.cube[:, :, z] + (cost[:, z][None, :] if z else cost[0, 0]) + price

    def _end(self, states: dict, trail: bytes) -> str:
        """The likeliest text of a word's states and the signs after it."""
        cost, steps = self._trail(trail)
        (a, b), (_, path) = min(states.items(), key=lambda s: s[1][0] + cost[s[0]])
        parts = _parts(path)
        for readings, dropped, choices in steps:
            for choice in [] if dropped[a, b] else choices:
                text = readings[choice[a, b]][0]
                parts.append(text)
                if text:
                    z = _CODES[ord(text)]
                    a, b = (b, z) if z else (0, 0)
        return "".join(parts)


def _single(core: bytes) -> bool:
    """Whether a span is single letters with gaps between."""
    return len(core) > 2 and not core[1::2].strip(b" .-_")


def _words(text: str) -> list[str]:
    """Runs of letters of a text whose characters are bytes."""
    return text.encode("latin-1").translate(_LETTERS).decode("latin-1").split()


def features(words: set[str]) -> set[str]:
    """Whole words, marked by a blank at the end, and their beginnings."""
    found = {f"{word} " for word in words if len(word) > 2}
    for size in PREFIXES:
        found.update(word[:size] for word in words if len(word) > size)
    return found


@dataclass
class ToxicityModel:
    """The trigram model, the share of toxic texts by feature, and weights of a text's evidence."""

    trigrams: list[float]
    shares: dict[str, float]
    weights: tuple[float, ...] = ()
    _search: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"trigrams": self.trigrams, "shares": self.shares, "weights": self.weights, "_search": None}

    def _hits(self, text: str, bytes_: np.ndarray) -> dict[int, float]:
        """By the beginning of a word, the share of the most that is known of it."""
        if self._search is None:
            self._search = ahocorasick.Automaton()
            stems: dict[str, dict[bool, float]] = {}
            for name, share in self.shares.items():
                stems.setdefault(name.rstrip(" "), {})[name[-1] == " "] = share
            for stem, share in stems.items():
                self._search.add_word(stem, (len(stem), share))
            self._search.make_automaton()
        letter, found = _T["letter"], {}
        # Ends come in order, so later finds at a beginning are longer.
        for last, (size, share) in self._search.iter(text) if self.shares else ():
            begin = last + 1 - size
            if begin and letter[bytes_[begin - 1]]:
                continue
            closed = last + 1 == len(text) or not letter[bytes_[last + 1]]
            if closed in share:
                found[begin] = share[closed]
        return found

    def evidence(self, texts: pa.Array, restorer: Restorer) -> np.ndarray:
        """Per text: one, the best feature's log odds, and logarithms of the toxic words and the length."""
        data, offsets, readings = restorer.restore(texts)
        lengths = np.diff(offsets)
        # A blank between texts keeps words of different rows apart.
        spread = np.full(len(data) + len(lengths), 32, np.uint8)
        spread[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)] = data
        starts = offsets + np.arange(len(offsets))
        shares: dict[int, list[float]] = {}
        for begin, share in self._hits(spread.tobytes().decode("latin-1"), spread).items():
            shares.setdefault(int(np.searchsorted(starts, begin, "right")) - 1, []).append(share)
        for row, reading in readings:
            found = self._hits(reading, np.frombuffer(reading.encode("latin-1"), np.uint8))
            shares.setdefault(row, []).extend(found.values())
        rows = np.zeros((len(texts), 4))
        rows[:, 0], rows[:, 3] = 1, np.log1p(lengths)
        for row, found in shares.items():
            odds = [math.log(p / (1 - p)) for p in (min(max(x, 1e-3), 1 - 1e-3) for x in found)]
            rows[row, 1] = max([0.0, *odds])
            rows[row, 2] = math.log1p(sum(o > 0 for o in odds))
        return rows

    def scores(self, texts: pa.Array, restorer: Restorer) -> np.ndarray:
        return 1 / (1 + np.exp(-self.evidence(texts, restorer) @ np.array(self.weights)))


def fit_weights(evidence: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton steps; without rows all weights but a low constant are zero."""
    weights = np.zeros(evidence.shape[1])
    weights[0] = -3.0
    for _ in range(50 if len(toxic) else 0):
        share = 1 / (1 + np.exp(-np.clip(evidence @ weights, -30, 30)))
        slope = evidence.T @ (share - toxic) + ridge * weights
        bend = (evidence * (share * (1 - share))[:, None]).T @ evidence + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(weights.tolist())


def train(docs: DataFrame, labels: DataFrame, trigrams: list[float], *, id_col: str, text_col: str, label_col: str) -> ToxicityModel:
    """Learn shares of features from a bounded sample of labelled texts, drawn row by row.

    About ``TRAINING_TEXTS`` texts enter. The driver gets the features that are toxic
    enough, with the words that begin so, and four numbers per text for the weights.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("label"))
    marked = stored(marked, "labels")
    texts = docs.select(F.col(id_col), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    share = TRAINING_TEXTS / max(1, texts.select(id_col).join(marked, id_col, "left_semi").count())
    texts = texts.withColumn("draw", drawn(id_col, "text"))
    some = texts.where(F.col("draw") < share).join(marked, id_col)
    sample = stored(some.select("text", (F.col("label") > 0).alias("label")).repartition(16), "toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(trigrams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, every, toxic = Restorer(shared.value), Counter(), Counter()
        for batch in chunks(batches, 0):
            data, offsets, readings = restorer.restore(batch.column(0))
            text, more = data.tobytes().decode("latin-1"), {}
            for row, reading in readings:
                more.setdefault(row, []).append(reading)
            for row, label in enumerate(batch.column(1).to_pylist()):
                whole = " ".join([text[offsets[row] : offsets[row + 1]], *more.get(row, [])])
                names = features(set(_words(whole)))
                every.update(names)
                if label:
                    toxic.update(names)
        names = list(every)
        columns = [pa.array([n.encode("latin-1") for n in names], pa.binary())]
        columns += [pa.array([c[n] for n in names], pa.int64()) for c in (every, toxic)]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "n", "toxic"])

    base = float(sample.agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.0)
    sums = sample.mapInArrow(count, "feature binary, n long, toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    smoothed = (F.col("toxic") + PRIOR_TEXTS * F.lit(base)) / (F.col("n") + PRIOR_TEXTS)
    known = stored(sums.where(F.col("n") >= LEAST_TEXTS).select("feature", smoothed.alias("share")), "features")
    toxic = known.where(F.col("share") >= LEAST_SHARE)
    stems = toxic.select(F.col("feature").alias("stem"))
    begins = F.explode(F.array(*[F.substring("feature", 1, size) for size in PREFIXES]))
    words = known.select("feature", "share", begins.alias("stem")).join(stems, "stem", "left_semi").select("feature", "share")
    rows = toxic.unionByName(words).distinct().collect()
    shares = {bytes(r["feature"]).decode("latin-1"): float(r["share"]) for r in sorted(rows, key=lambda r: bytes(r["feature"]))}
    draft = shared_value(docs.sparkSession, ToxicityModel(trigrams, shares))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = draft()
        restorer = Restorer(model.trigrams)
        for batch in chunks(batches, 0):
            columns = [*model.evidence(batch.column(0), restorer).T, batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "c", "d", "label"])

    seen = sample.mapInArrow(weigh, "a double, b double, c double, d double, label boolean").toArrow().to_pandas()
    seen = seen.sort_values(list(seen.columns))
    weights = fit_weights(seen[["a", "b", "c", "d"]].to_numpy(), seen["label"].to_numpy(float))
    return ToxicityModel(trigrams, shares, weights)


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_out: int = 1,
) -> ToxicityModel:
    """Count trigrams of all texts, and learn labels of those ids that are not held out."""
    fold = share_of(id_col, folds) == held_out
    trigrams = surprise(count_trigrams(docs, text_col))
    return train(docs.where(~fold), labels.where(~fold), trigrams, id_col=id_col, text_col=text_col, label_col=label_col)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 3,
    held_out: int = 1,
    threshold: float = 0.7,
) -> DataFrame:
    """``(id_col, held_out, score, predicted)``, one row per document.

    Learns labels from documents whose id's crc32 modulo ``folds`` is not ``held_out``; the
    trigram model counts all texts. The score, 0 to 1, is a logistic regression on the best
    feature, the number of toxic words and the length; null and empty texts have it too. Null labels and labels of null
    ids are not learned; of repeated labels of an id the highest counts. Repeated rows and
    null ids are scored like any others.
    """
    fold = share_of(id_col, folds) == held_out
    model = learn_toxicity(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds, held_out=held_out)
    shared = shared_value(docs.sparkSession, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        restorer = Restorer(model.trigrams)
        for batch in chunks(batches, 2):
            scores = model.scores(batch.column(2), restorer)
            predicted = pa.array((scores >= threshold).astype(np.int32))
            columns = [batch.column(0), batch.column(1), pa.array(scores), predicted]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "held_out", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col), fold.alias("held_out"), F.col(text_col))
    return source.mapInArrow(score, f"`{id_col}` {id_type}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that the model scores at the threshold or above; all columns stay."""
    shared = shared_value(docs.sparkSession, model)
    place = docs.columns.index(text_col)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        restorer = Restorer(model.trigrams)
        for batch in chunks(batches, place):
            yield batch.filter(pa.array(model.scores(batch.column(place), restorer) < threshold))

    return docs.mapInArrow(sift, docs.schema)
