"""Runs of words against a loop over all periods."""

import random
import zlib
from hashlib import sha256

import pytest

from tidemark.llm.periodic import LEAST_RUN, collapse, find_runs, plant_runs, run_digests, runs_by_text


def plain_runs(words, least=LEAST_RUN):
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, 2 * q):
                part = words[i : i + size]
                if not any(part[p:] == part[: size - p] for p in range(1, q)):
                    found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("least", [1, 2, 5, 12, 13])
def test_runs_equal_a_loop(least):
    rng = random.Random(least)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            letters, n = rng.choice([1, 2, 3, 9]), rng.choice([0, 1, 2, 12, 30, 70])
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n:
                start, q = rng.randrange(n), rng.randrange(1, 12)
                words = words[:start] + [words[start + k % q] if start + k % q < n else b"x" for k in range(n - start)]
            texts.append(words)
        want = {k: plain_runs(words, least) for k, words in enumerate(texts)}
        assert runs_by_text(texts, least) == {k: runs for k, runs in want.items() if runs}
        assert all(collapse(words, want[k]) == plain_collapse(words, want[k]) for k, words in enumerate(texts))


def test_long_runs_take_little_time():
    assert runs_by_text([[b"a"] * 100_000]) == {0: [(0, 100_000, 1)]}
    assert runs_by_text([[b"a", b"b", b"c"] * 30_000, [b"a"] * 11]) == {0: [(0, 90_000, 3)]}
    # A hundred stretches of one word, each after another word.
    words = [w for k in range(100) for w in [b"%d" % k] + [b"a"] * 400]
    assert runs_by_text([words]) == {0: [(401 * k + 1, 400, 1) for k in range(100)]}


def test_rows(spark, docs_of):
    text = "x " + "a b c " * 5 + "y\n" + "d\t" * 12 + "é"
    docs = docs_of([(1, text), (1, text), (None, "é " * 12), (2, None), (3, ""), (4, " \n"), (5, "a " * 11), (6, "w " * 50_000)])
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()}
    # Where a run ends, the next word is not its continuation.
    assert got[1, 30] == ([(1, 15, 3), (17, 12, 1)], "x a b c y d é")
    assert got[None, 12] == ([(0, 12, 1)], "é")
    assert got[2, 0] == got[3, 0] == got[4, 0] == ([], "")
    assert got[5, 11] == ([], " ".join("a" * 11)) and got[6, 50_000] == ([(0, 50_000, 1)], "w")
    assert find_runs(docs).count() == 8 and find_runs(docs.limit(0)).count() == 0
    rows = {r.doc_id: r for r in run_digests(find_runs(docs)).collect()}
    assert (rows[1].n_runs, rows[1].start, rows[1].length, rows[1].period, rows[1].exponent_milli) == (2, 1, 15, 3, 5000)
    assert rows[1].runs_sha256 == sha256(b"1,15,3\n17,12,1\n").hexdigest()
    assert (rows[2].n_runs, rows[2].start, rows[2].exponent_milli) == (0, None, None)
    assert rows[2].runs_sha256 == rows[2].collapsed_sha256 == sha256(b"").hexdigest()


def test_ties_choose_the_first(spark, docs_of):
    docs = docs_of([(1, " ".join(["a"] * 12 + ["x"] + ["b"] * 12))])
    row = run_digests(find_runs(docs)).first()
    assert (row.n_runs, row.start, row.length) == (2, 0, 12)


def test_planted_texts(spark, docs_of):
    rng = random.Random(4)
    pairs = [(k, " ".join(str(rng.randrange(1000)) for _ in range(rng.randrange(60)))) for k in range(200)]
    got = {r.doc_id: (r.text or "").split() for r in plant_runs(docs_of([*pairs, (None, "a b"), (777, None)])).collect()}
    assert got[None] == ["a", "b"] and got[777] == []
    for k, text in pairs:
        h, words = zlib.crc32(str(k).encode()), text.split()
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert got[k] == words
