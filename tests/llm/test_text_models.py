"""Toxicity, languages and token counts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_count
from tidemark.llm.language import identify_languages, presence
from tidemark.llm.token_count import Counter, count_tokens, read_merges
from tidemark.llm.toxicity import (
    Restorer,
    count_trigrams,
    disguised,
    drop_toxic,
    learn_toxicity,
    read_span,
    score_toxicity,
    surprise,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a", "  ", "it's don't we'll I'VE x''s !'s 's's 12'd", "<|endoftext|>hello<|startoftext|>É<|endoftext|>", "İstanbul ΑΣ ΣΑΣ",
    "e\u0301 <|endoftext|>\u0301", "aaaaaaa" * 300 + " b", "\x1c a\x85b\u180ec\u200bd\ufeff", "日本語 テスト １２３ ½", "the" * 3000, "'", "'S", "😀👍🏽 ok", "\x00",
]


def library(texts):
    return [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_tokens_equal_library():
    rng = random.Random(1)
    signs = "abcde 'stmdlrevSTß éΣ12½ \n\t.,!<|>İ日 "
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)]
    assert Counter(read_merges(PATH)).count(pa.array(texts)).tolist() == library(texts)


def test_long_and_forgotten_pre_tokens(monkeypatch):
    monkeypatch.setattr(token_count, "LONG", 8)
    monkeypatch.setattr(token_count, "REMEMBERED", 3)
    counter, texts = Counter(read_merges(PATH)), ["banana " * 3, "internationalization " * 2, "aaaaaaaaaaaaaaaaaaab abab"]
    for _ in range(2):
        assert counter.count(pa.array(texts)).tolist() == library(texts)


def test_count_tokens(spark, docs_of, tmp_path):
    docs = docs_of([(1, None), (2, "é"), (2, "é"), (None, "word " * 3000), (3, "")])
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs, PATH).collect())
    assert rows == [("1", 0, 0, False), ("2", 2, 1, False), ("2", 2, 1, False), ("3", 0, 0, False), ("None", 15000, 3000, True)]
    assert count_tokens(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        read_merges(public_tokenizers.path("byte_bpe_50k.json"))


def held(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


WORDS = {"aa": ["lamo", "tepi", "sola", "rumo"], "bb": ["schtz", "kront", "wrimp", "glund"]}


def prose(rng, lang, size):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(size))


def test_languages(docs_of):
    rng = random.Random(2)
    langs = {k: rng.choice(["aa", "bb"]) for k in range(120)}
    odd = [(200, None), (201, ""), (202, "12 % 3"), (203, "lamo tepi " * 20_000), (None, "kront glund"), (204, "wrimp"), (204, "wrimp")]
    docs = docs_of([(k, prose(rng, lang, 20)) for k, lang in langs.items()] + odd, langs | {204: None})
    rows = identify_languages(docs).collect()
    assert len(rows) == 127 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        want = {**langs, 200: "und", 201: "und", 202: "und", 203: "aa", None: "bb", 204: "bb"}[r.doc_id]
        assert r.lang_pred == want
    unlabelled = identify_languages(docs_of([(1, "lamo")])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
    assert identify_languages(docs.limit(0)).count() == 0


def test_presence_is_the_blended_spectrum():
    texts = ["abab", "", "b a"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    kernel = presence(data, np.array([0, 4, 4, 7]))
    assert np.allclose((kernel**2).sum(axis=1), [1, 0, 1])
    assert np.isclose((kernel[0] * kernel[2]).sum(), 0.2 * 2 / np.sqrt(2 * 3), atol=1e-6)


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        words = prose(rng, "aa", 30).split()
        bad = k % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["stupid", "moron"]))
        rows.append((k, " ".join(words), int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    return docs, labels


def test_disguised_words_are_restored(toxic_docs):
    model = surprise(count_trigrams(toxic_docs[0], "text"))
    for span in (b"5tup1d", b"stuuuuupid", b"s t u p i d", b"s.t.u.p.i.d", b"st*pid", b"$tup!d"):
        assert "stupid" in read_span(span, model)
    assert read_span(b"mor0n", model).strip() == "moron"
    text = b"so 5tup1d, a s t u p i d moooron! x-y 1999 100%"
    data = np.frombuffer(text, np.uint8)
    assert [text[a:b] for a, b in disguised(data, np.array([0, len(text)]))] == [b"5tup1d", b"a s t u p i d", b"moooron"]
    restorer = Restorer(model)
    _, _, readings = restorer.restore(pa.array(["plain words", None, "", "mor0n"]))
    assert [(row, text.strip()) for row, text in readings] == [(3, "moron")]


def test_every_ambiguous_word_is_read(spark):
    rng = random.Random(6)
    insults = ["stupid", "moron", "idiot", "asshole", "clown"]
    rows = []
    for k in range(400):
        words = prose(rng, "aa", 30).split()
        for _ in range(3 * (k % 4 == 0)):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    hidden = "$tupid @sshole (lown !diot idio+ m0ron! stuupid iddiot stu-pid mo.ron $tup!d $tupid!! idio+!!! stupid! **moron** asshole$$".split()
    clean = [(2000 + k, prose(rng, "aa", 30).replace(" ", mark + " ")) for k, mark in enumerate(["!", "$", "***", "!!", " (", " @"])]
    docs = [r[:2] for r in rows] + [(1000 + k, word) for k, word in enumerate(hidden)] + clean
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in score_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()}
    assert [w for k, w in enumerate(hidden) if not found[1000 + k]] == []
    assert [k for k, _ in clean if found[k]] == []
    assert all(found[k] == (k % 4 == 0) for k in range(400))


def test_parts_read_like_whole_spans(toxic_docs):
    model, rng = surprise(count_trigrams(toxic_docs[0], "text")), random.Random(7)
    restorer = Restorer(model)
    for _ in range(1500):
        span = "".join(rng.choice("deimnoprstu" * 2 + "0$!15.-é") for _ in range(rng.randrange(1, 14))).encode("latin-1")
        assert restorer.read_parts(b"", span, b"").strip() == read_span(span, model).strip()


def test_words_at_any_place_of_a_long_span(toxic_docs):
    model = surprise(count_trigrams(toxic_docs[0], "text"))
    for place in range(70):
        text = "lamo" * (place // 4) + "lamo"[: place % 4] + "stupid" + "lamo" * 20
        span = "_".join(text).encode()
        assert "stupid" in read_span(span, model), place
        assert Restorer(model).read_parts(b"", span, b"").strip() == read_span(span, model).strip()
    assert len(read_span(b"5" * 10 + b"lam0" * 5000, model)) > 20_000


def test_toxicity(spark, toxic_docs):
    docs, labels = toxic_docs
    extra = [(1000, None), (1001, ""), (None, "you 5tup1d m0ron, st*pid"), (1002, "lamo " * 40_000), (1003, "mor0n " * 3), (1003, "mor0n " * 3), (1004, "s t u p i d and m o r o n")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == 407 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (held(r.doc_id, 3) == 1) for r in rows if r.doc_id is not None)
    known = [r for r in rows if r.doc_id is not None and r.doc_id < 1000]
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in known)
    found = {r.doc_id: r.predicted for r in rows}
    assert (found[None], found[1000], found[1001], found[1002], found[1003], found[1004]) == (1, 0, 0, 0, 1, 1)
    model = learn_toxicity(docs, labels)
    wide = docs.selectExpr("doc_id", "text", "'x' AS score", "1 AS predicted")
    kept = drop_toxic(wide, model)
    assert kept.columns == wide.columns and kept.count() == sum(not r.predicted for r in rows)
    empty = score_toxicity(docs.limit(0), labels.limit(0))
    assert empty.count() == 0
    assert {r.predicted for r in score_toxicity(docs, labels.limit(0)).collect()} == {0}
