"""Spelling variants against a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling
from tidemark.llm.spelling import count_words, group_variants, misspelled, near_pairs, spelling_variants


def one_edit_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_groups(counts, least=5, times=5):
    words = {w: n for w, n in counts.items() if n >= least}
    near = {w: [x for x in words if one_edit_apart(w, x)] for w in words}
    best = {w: min(some, key=lambda x: (-words[x], x)) for w, some in near.items() if some}
    form = {w: f for w, f in best.items() if words[f] >= times * words[w]}
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words.get(form.get(w))))
    return sorted(out)


def some_words(rng, letters, n):
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 6, 7, 7, 8]))) for _ in range(n)}
    for word in list(words)[: n // 2]:
        k, letter = rng.randrange(len(word)), rng.choice(letters)
        words |= {word[:k] + word[k + 1 :] or letter, word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :]}
    return sorted(words)


def test_near_pairs_equal_all_pairs():
    rng = random.Random(5)
    for letters in ("ab", "abé", "abcdefgh", "añ文😀"):
        one, two = some_words(rng, letters, 60), some_words(rng, letters, 60)
        got = {(one[i], one[j]) for i, j in zip(*near_pairs(one))}
        assert got == {(a, b) for k, a in enumerate(one) for b in one[k + 1 :] if one_edit_apart(a, b)}
        got = sorted((one[i], two[j]) for i, j in zip(*near_pairs(one, two)))
        assert got == sorted((a, b) for a in one for b in two if one_edit_apart(a, b))
    assert [len(x) for x in near_pairs(["ab"], [])] == [0, 0]


@pytest.mark.parametrize("tile, task", [(2048, 1 << 15), (7, 64)])
def test_groups_equal_all_pairs(spark, rows, monkeypatch, tile, task):
    """Large blocks are cut into many tiles; every pair of words still meets once."""
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "TASK_WORDS", task)
    rng = random.Random(7)
    words = some_words(rng, "aounrmtdlxé", 150) + some_words(rng, "ax", 60)
    counts = {w: rng.choice([4, 5, 5, 24, 25, 26, 125, 700, 5000]) for w in words}
    df = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n long")
    got = rows(group_variants(df))
    assert got == sorted(plain_groups(counts), key=repr) and len({r[2] for r in got}) < len(got)
    assert rows(group_variants(df.where("word = 'none'"))) == []


def test_chains_end_at_the_root(spark, rows):
    counts = {"a" * (k + 6): 5 ** (k + 1) for k in range(7)}
    got = {r[0]: r[2] for r in rows(group_variants(spark.createDataFrame([*counts.items()], "word string, n long")))}
    assert set(got.values()) == {"a" * 12}


def test_texts(spark, rows, docs_of):
    rng = random.Random(9)
    letters = "abcdeé×÷À"
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([5, 6, 7]))) for _ in range(80)]
    pairs = [(k, " ".join(rng.choice(pool) for _ in range(60)) + "_Ā1 Abcdef") for k in range(120)]
    pairs += [(1, pairs[1][1]), (None, "abcdef " * 9), (None, None), (500, ""), (501, "z" * 200_000), (502, "xyzxyz-" * 30_000)]
    counts = Counter()
    for k, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    docs = docs_of(pairs)
    assert rows(count_words(docs, edit=misspelled)) == sorted(counts.items(), key=repr)
    assert rows(spelling_variants(docs, edit=misspelled)) == sorted(plain_groups(counts), key=repr)
    assert spelling_variants(docs.limit(0)).count() == 0


def test_counts_pass_on_before_they_grow(spark, rows, docs_of, monkeypatch):
    docs = docs_of([(k, "abcdef ghijkl") for k in range(20)])
    monkeypatch.setattr(spelling, "MOST_COUNTED", 1)
    assert rows(count_words(docs)) == [("abcdef", 20), ("ghijkl", 20)]
