"""Language scores and readings of disguised words against plain code."""

import itertools
import random

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.language import SLOTS, WEIGHTS, identify_languages
from tidemark.llm.toxicity import BREAK_COST, GAP_COST, LEET, LEET_COST, RUN_COST, WILD_COST, read_span, surprise


def gram_sets(text):
    """Per n the slots of a text's n-grams, one gram at a time."""
    data = bytes((b | 32) if chr(b).isalpha() and b < 128 else 32 if b < 128 else b for b in text.encode())
    sets = []
    for n, slots in enumerate(SLOTS, 1):
        grams = {int.from_bytes(data[k : k + n]) for k in range(len(data) - n + 1)}
        sets.append(grams if n == 1 else {(g * 2654435769 % 2**32) >> (33 - slots.bit_length()) for g in grams})
    return sets


def kernel(one, two):
    return sum(w * len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1)) for w, a, b in zip(WEIGHTS, one, two))


def test_languages_equal_plain_ridge_regression(spark, docs_of):
    """All texts are few enough to be landmarks, so nothing depends on a draw."""
    rng = random.Random(2)
    words = {"aa": ["thing", "other", "where", "with"], "bb": ["chose", "autre", "où", "avec"], "cc": ["dinge", "über", "wo", "mit"]}
    texts, langs = [], {}
    for k in range(60):
        langs[k] = rng.choice(["aa", "bb", "cc", None])
        some = words[langs[k] or rng.choice(["aa", "bb", "cc"])]
        texts.append((k, " ".join(rng.choice(some) for _ in range(rng.randint(3, 12)))))
    got = {r.doc_id: r for r in identify_languages(docs_of(texts, langs)).collect()}
    held = {k: got[k].held_out for k in got}
    train = [(langs[k], gram_sets(t)) for k, t in texts if langs[k] and not held[k]]
    names = sorted({name for name, _ in train})
    between = np.array([[kernel(a, b) for _, b in train] for _, a in train])
    values, vectors = np.linalg.eigh(between)
    useful = values > 1e-6 * values[-1]
    root = vectors[:, useful] / np.sqrt(values[useful])
    z = between @ root
    y = np.array([[1.0 if name == own else -1.0 for name in names] for own, _ in train])
    gram = z.T @ z
    weights = root @ np.linalg.solve(gram + language.RIDGE * np.trace(gram) / len(gram) * np.eye(len(gram)), z.T @ y)
    for k, text in texts:
        scores = np.array([kernel(gram_sets(text), b) for _, b in train]) @ weights
        best = int(scores.argmax())
        assert got[k].lang_pred == names[best]
        assert got[k].score == pytest.approx(1 / np.exp(4 * (scores - scores[best])).sum(), abs=2e-3)


def readings(span):
    """Every reading of a span with its cost, by the rules and nothing shared."""
    signs = []
    for char, run in itertools.groupby(span):
        n = len(list(run))
        if char in LEET:
            one = [(c, WILD_COST if char == "*" else LEET_COST) for c in LEET[char]] + [(" ", BREAK_COST)]
            signs += [one] * n
        elif char.isalpha():
            signs.append([(char, 0.0)] if n == 1 else [(char, RUN_COST), (char * 2, 0.0 if n == 2 else RUN_COST)])
        else:
            signs += [[(" ", 0.0), ("", GAP_COST)]]
    for chosen in itertools.product(*signs):
        yield "".join(text for text, _ in chosen), sum(cost for _, cost in chosen)


def language_cost(text, model):
    """The cost of the letters of a text, a blank at its end; blanks in a row count as one."""
    total, before = 0.0, (0, 0)
    for char in text + " ":
        code = 0 if char == " " else ord(char) - ord("a") + 1
        if before[1] or code:
            a = before[0] if before[1] else 0
            total += model[a, before[1], code]
        before = (before[1], code) if code else (0, 0)
    return total


def test_spans_read_like_the_best_of_all_readings():
    rng = np.random.default_rng(4)
    model = np.array(surprise(rng.integers(0, 50, (28, 28, 28)) ** 2)).reshape(28, 28, 28)
    picker = random.Random(6)
    signs = "abtsiio0013$@!_-.*"
    for _ in range(300):
        span = "".join(picker.choice(signs) for _ in range(picker.randint(1, 6)))
        span = span.replace("*", "@", max(0, span.count("*") - 1))
        cost = {}
        for text, price in readings(span):
            cost[text] = min(cost.get(text, np.inf), price + language_cost(text, model))
        got = read_span(span.encode(), model.reshape(-1).tolist())
        least = min(cost.values())
        found = [value for text, value in cost.items() if text.rstrip(" ") == got.rstrip(" ")]
        assert found and min(found) == pytest.approx(least), (span, got)
