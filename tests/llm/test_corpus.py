"""Decontamination, near copies, archives, rules and packing against plain loops."""

import base64
import gzip
import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.common import drop_rows
from tidemark.llm.decontaminate import drop_contaminated, find_contamination
from tidemark.llm.jaccard import drop_near_duplicates, jaccard_components, search_overlaps
from tidemark.llm.packing import BinSize, attention_cost, pack, pack_documents, word_count
from tidemark.llm.quality import BASE, POLICIES, RULE_NAMES, ablations, apply_policy, mask_of, measure
from tidemark.llm.warc import normalise, read_index, read_records, records, round_trip, write_archives

SPACES = "[^\x20\x09-\x0d]+"


def prose(rng, size, words=40):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(size))


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


# Decontamination


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_contamination(text, items):
    words, hit, names = item_words(text), set(), set()
    for name, item in items:
        parts = item_words(item)
        size = min(10, len(parts))
        for at in range(len(parts) - size + 1 if size else 0):
            for k in range(len(words) - size + 1):
                if words[k : k + size] == parts[at : at + size]:
                    hit.update(range(k, k + size))
                    names.add(name)
    joined = ",".join(sorted(names))
    return len(words), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)


@pytest.fixture
def contaminated(spark, docs_of):
    rng = random.Random(6)
    items = [(k, prose(rng, rng.choice([3, 7, 10, 14, 30]), 500)) for k in range(12)] + [(12, None), (13, "..."), (14, "Zé one"), (14, "Zé one"), (115, "x1 " * 12), (None, "nul item of five words")]
    texts = [(0, None), (1, ""), (2, "zé, ONE! zé one"), (2, "zé, ONE! zé one"), (None, "a nul-item of FIVE words b"), (3, "x1 " * 30), (4, "word " * 60_000 + items[3][1])]
    for k in range(5, 60):
        parts = [prose(rng, rng.randrange(20), 500)]
        for _ in range(rng.randrange(3)):
            words = (rng.choice(items)[1] or "").split()
            begin = rng.randrange(len(words) + 1)
            parts += [".".join(words[begin : begin + rng.randrange(4, 40)]), prose(rng, rng.randrange(6), 500)]
        texts.append((k, " ".join(parts)))
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, words string")
    return texts, [("" if i is None else str(i), t) for i, t in items], docs_of(texts), benchmark


def test_contamination(contaminated):
    texts, items, docs, benchmark = contaminated
    got = sorted((str(r.doc_id), *r[1:]) for r in find_contamination(docs, benchmark).collect())
    assert got == sorted((str(i), *plain_contamination(t, items)) for i, t in texts)
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(str(i) for i, t in texts if not plain_contamination(t, items)[-1])
    assert find_contamination(docs.limit(0), benchmark).count() == 0
    assert not any(r.contaminated for r in find_contamination(docs, benchmark.limit(0)).collect())


# Near copies


def shingles(text):
    words = re.findall(SPACES, lowered(text))
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_components(texts):
    sets, root = [shingles(t) for _, t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    ids = defaultdict(list)
    for k, r in enumerate(root):
        if texts[k][0] is not None:
            ids[r].append(texts[k][0])
    return [(i, len(sets[k]), min(ids[root[k]], default=None)) for k, (i, _) in enumerate(texts)]


def near_copies(rng, count):
    texts, bases = [], [prose(rng, rng.randrange(5, 60), 3000) for _ in range(12)]
    for _ in range(count):
        words = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [f"v{rng.randrange(10**6)}"]
        texts.append(rng.choice([" ", "\n", "\t\x0b"]).join(words).replace("w1", "W1"))
    return texts


ODD = [None, "", " \n", "one", "One", "a b c d", "a b c e", "é " * 9, "x y z " * 30_000]


@pytest.mark.parametrize("block", [1 << 21, 150])
def test_components(monkeypatch, docs_of, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    rng = random.Random(8)
    texts = list(enumerate(near_copies(rng, 250) + ODD, 5)) + [(2, "one"), (2, "one"), (None, "lonely null here and now"), (None, "one")]
    docs = docs_of(texts)
    got = sorted((tuple(r) for r in jaccard_components(docs).collect()), key=repr)
    assert got == sorted(plain_components(texts), key=repr)


def test_drop_near_duplicates(docs_of):
    rng = random.Random(9)
    texts = list(enumerate(near_copies(rng, 120) + ODD)) + [(1002, "three"), (1002, "three"), (1500, "three"), (None, "four"), (None, "four"), (700, None)]
    docs = docs_of(texts)
    kept = drop_near_duplicates(docs)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns
    empty = [t for t in texts if not shingles(t[1])]
    full = [r for r in rows if shingles(r[1])]
    assert Counter(r for r in rows if not shingles(r[1])) == Counter(empty)
    named = plain_components(texts)
    groups = {(c, s) if c is None else c for (_, s, c) in named if s}
    assert len(full) == len(groups)
    assert Counter(i for i, _ in full) == Counter(c if not isinstance(c, tuple) else None for c in groups)
    assert drop_near_duplicates(docs.limit(0)).count() == 0
    assert jaccard_components(docs.limit(0)).count() == 0


def test_unlike_texts_are_ruled_out_by_few_bits(monkeypatch, docs_of):
    """Linked texts all stay likely, however many units and buckets there are; others send only a sample."""
    monkeypatch.setattr(jaccard, "SAMPLE_BUCKET_BYTES", 2000)
    monkeypatch.setattr(jaccard, "SAMPLE_UNIT_BYTES", 3000)
    monkeypatch.setattr(jaccard, "SAMPLE_UNIT_ROWS", 40)
    rng = random.Random(14)
    texts = list(enumerate([prose(rng, 80, 3000) for _ in range(300)] + near_copies(rng, 60) + ODD + ["a b", "A  b", "a b c"]))
    rows = {r.id: r for r in jaccard.signatures(docs_of(texts), "doc_id", "text").collect()}
    assert len(rows) == len(texts)
    named = plain_components(texts)
    sets = defaultdict(set)
    for (_, text), (_, _, component) in zip(texts, named):
        sets[component].add(frozenset(shingles(text)))
    for (i, text), (_, size, component) in zip(texts, named):
        assert rows[i].n_shingles == size and rows[i].size == len((text or "").encode())
        assert rows[i].likely or len(sets[component]) == 1
    assert sum(rows[i].likely for i in range(300)) < 10
    assert {rows[i].likely for i, t in texts if not shingles(t)} == {False}


def test_only_likely_texts_are_sent_whole(docs_of):
    rng = random.Random(15)
    one, other = prose(rng, 60, 3000), prose(rng, 60, 3000)
    docs = docs_of([(1, one), (2, one + " more"), (2, one.upper()), (3, other), (4, other + " more"), (None, one + " end"), (5, None)])
    signed = jaccard.signatures(docs, "doc_id", "text")
    assert {(r.id, r.likely) for r in signed.collect()} == {(1, True), (2, True), (3, True), (4, True), (None, True), (5, False)}
    some = signed.withColumn("likely", F.col("likely") & F.coalesce(F.col("id") < 3, F.lit(True)))
    sent = jaccard.shared_shingles(docs, "doc_id", "text", some).collect()
    assert sorted(r.n for r in sent) == [56, 57, 57] and all(len(r.shingles) == 56 for r in sent)
    assert {r["class"] for r in sent} == {r["class"] for r in some.where("likely").collect()}
    assert sorted(r.doc_id or 0 for r in drop_near_duplicates(docs).collect()) == [1, 3, 5]


def test_search_overlaps_equals_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 60, 25)
    sets = sorted((np.unique(np.concatenate([base[: rng.integers(10, 25)], rng.integers(100, 140, rng.integers(0, 6))])) for _ in range(80)), key=len)
    n = np.array([len(s) for s in sets])
    root = search_overlaps(n, np.concatenate(sets), n)
    plain = list(range(len(sets)))
    for a, b in combinations(range(len(sets)), 2):
        o = len(np.intersect1d(sets[a], sets[b]))
        if 100 * o >= 75 * (n[a] + n[b] - o):
            low, high = sorted((plain[a], plain[b]))
            plain = [low if r == high else r for r in plain]
    assert root.tolist() == plain


def test_families_of_near_copies_cost_a_search_each():
    """Two thousand linked sets, and two families that only two of their outliers join."""
    rng = np.random.default_rng(0)
    base, other = rng.integers(0, 1 << 60, 400), rng.integers(0, 1 << 60, 400)
    sets = []
    for k in range(2000):
        one = (base if k % 2 else other).copy()
        one[rng.integers(0, 400, rng.integers(1, 20))] = rng.integers(0, 1 << 60)
        sets.append(np.unique(one))
    for k in range(50, 400, 50):
        sets.append(np.unique(np.concatenate([base[k:], other[:k]])))
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    begin = time.process_time()
    root = search_overlaps(n, np.concatenate(sets), n)
    # Steps of 50 of 400 shingles link the families in a chain.
    assert len(set(root.tolist())) == 1 and time.process_time() - begin < 10
    known = np.arange(len(n)) % 7
    assert len(set(search_overlaps(n, np.concatenate(sets), n, known).tolist())) == 1


def test_links_across_blocks_equal_those_of_one(monkeypatch, spark, docs_of):
    """Many blocks of one group: hubs, then only what is left between components."""
    rng = random.Random(21)
    base = prose(rng, 60, 3000).split()
    texts, words = [], base
    for k in range(160):
        if k % 8 == 0:
            words = words[3:] + [f"n{k}", f"m{k}", f"o{k}"]
        at = rng.randrange(len(words))
        texts.append((k, " ".join(words[:at] + [f"v{k}"] + words[at + 1 :])))
    expected = sorted(plain_components(texts))
    assert len({c for _, _, c in expected}) < 40
    for block in (100_000, 500):
        monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
        monkeypatch.setattr(jaccard, "HUBS", 2)
        assert sorted(map(tuple, jaccard_components(docs_of(texts)).collect())) == expected


def test_more_buckets_than_bits(monkeypatch, docs_of):
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 200)
    monkeypatch.setattr(jaccard, "MOST_BUCKETS", 4)
    rng = random.Random(8)
    texts = list(enumerate(near_copies(rng, 60)))
    assert sorted(map(tuple, jaccard_components(docs_of(texts)).collect())) == sorted(plain_components(texts))


def test_drop_rows(spark):
    docs = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (None, "a", 4), (2, None, 5), (3, "c", 6)], "id long, text string, version long")
    keys = docs.select("id", F.xxhash64("text").alias("version"), F.expr("version < 3 AS once")).where("not (id = 3) or id is null").distinct()
    kept = drop_rows(docs, keys, id_col="id", text_col="text").collect()
    assert sorted(r.id for r in kept) == [1, 3] and {r.version for r in kept} <= {1, 2, 6}


# Archives


def plain_archive(pages):
    newest = defaultdict(list)
    for i, _, html in pages:
        newest[html or ""].append(i)
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        ids = [x for x in newest[html or ""] if x is not None]
        top = max(ids, default=None)
        again = top is not None and i != top
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if again else "response", top if again else None, True))
    return out


PAGES = [
    (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/ \r\nWARC: y", "é\r\n\r\nWARC/1.0\r\n"), (4, "u", None), (5, "u", ""), (5, "u", ""),
    (None, "n", "<p>x</p>"), (None, "n", "only"), (None, "n", "only"), (6, "long", "z" * 700_000), (7, "", "\r\n\r\n"),
]


def test_archives(spark, tmp_path):
    df = spark.createDataFrame([(*p, "d") for p in PAGES], "page_id long, url string, html string, digest string")
    got = sorted((tuple(r) for r in round_trip(df).collect()), key=repr)
    assert got == sorted(plain_archive(PAGES), key=repr)
    assert round_trip(df.limit(0)).count() == 0
    write_archives(df.coalesce(2), f"file://{tmp_path}/whole")
    whole = sorted((tmp_path / "whole").glob("*.gz"))
    done = normalise(spark, f"file://{tmp_path}/whole", f"file://{tmp_path}/members").collect()
    assert len(done) == len(whole)
    for row in done:
        # Same bytes, but a member per record, each readable alone.
        source, target = row.source.removeprefix("file:"), row.archive.removeprefix("file:").replace("//", "/")
        assert gzip.open(source).read() == gzip.open(target).read()
    index = read_index(spark, f"file://{tmp_path}/members")
    assert index.count() == len(PAGES)
    for row in index.collect():
        data = open(row.archive.removeprefix("file:").replace("//", "/"), "rb").read()
        text = gzip.decompress(data[row.offset : row.offset + row.length])
        assert text.startswith(b"WARC/1.1\r\n") and row.record_id.encode() in text
    # A task that runs again leaves the same files.
    assert normalise(spark, f"file://{tmp_path}/whole", f"file://{tmp_path}/members").count() == len(whole)
    assert read_records(read_index(spark, f"file://{tmp_path}/members")).where("not intact").count() == 0


def test_broken_archives(tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    store = pyarrow.fs.LocalFileSystem()
    for text, message in ((good[:-6], "ends"), (good + b"junk", "ends"), (good.replace(b"3", b"2"), "longer"), (good + b"HTTP/1\r\n\r\n", "starts")):
        (tmp_path / "a.gz").write_bytes(gzip.compress(text))
        with pytest.raises(ValueError, match=message), store.open_input_stream(str(tmp_path / "a.gz"), compression=None) as file:
            list(records(file))
    (tmp_path / "b.gz").write_bytes(gzip.compress(good) + gzip.compress(good))
    with store.open_input_stream(str(tmp_path / "b.gz"), compression=None) as file:
        assert [block for _, _, block in records(file)] == [b"abc", b"abc"]


# Quality rules


def plain_measures(text):
    text = text or ""
    words = re.findall(SPACES, text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(k, k + 5))
    lines = [line for line in text.split("\n") if re.search(SPACES, line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_measures(docs_of, plan):
    rng = random.Random(12)
    texts = [None, "", " \n\t", "a", "a b c d e", "a a a a a a", "x\n\nx\n y\nx\r\n", "é#$ 日|\x1c \u00a0z", "one two three four five " * 300, "w " * 60_000]
    texts += ["".join(rng.choice(["a", "b", " ", "\n", "cd", "%", "é"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = docs_of(list(enumerate(texts)) + [(None, "null id"), (3, "a")])
    ledger = measure(docs)
    rows = {r.doc_id: r for r in ledger.collect()}
    assert ledger.count() == len(texts) + 2
    for k, text in enumerate(texts):
        assert tuple(rows[k][1:7]) == plain_measures(text), text
    assert "Python" not in plan(ledger) and "Exchange" not in plan(ledger)
    judged = apply_policy(ledger, POLICIES["v2"]).collect()
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in judged)
    assert measure(docs.limit(0)).count() == 0


def test_ablations(spark):
    ledger = spark.createDataFrame([(0,), (1,), (1,), (2,), (3,), (4,), (12,)], "failed int")
    rows = {(r.policy, r.without): (r.kept, r.only_here) for r in ablations(ledger, {"p": BASE, "q": mask_of("symbols")}).collect()}
    assert rows == {("p", None): (3, 0), ("p", "few_words"): (4 + 1, 2), ("p", "repeated_words"): (4, 1), ("q", None): (5, 0), ("q", "symbols"): (7, 2)}
    assert len(RULE_NAMES) == len(set(RULE_NAMES))


# Packing


def plain_pack(lengths, sizes):
    bins = []
    left = sum(lengths)
    for length in lengths:
        fitting = [b for b in bins if b[0] - b[1] >= length]
        if fitting:
            chosen = min(fitting, key=lambda b: (b[0] - b[1], bins.index(b)))
        else:
            size = min((s for s in sizes if s.capacity >= length), key=lambda s: (s.cost / min(s.capacity, left), s.capacity))
            chosen = [size.capacity, 0, len(bins)]
            bins.append(chosen)
        chosen[1] += length
        left -= length
    return [min(s.capacity for s in sizes if s.capacity >= b[1]) for b in bins], [b[1] for b in bins]


def test_pack_is_best_fit():
    rng = random.Random(13)
    for sizes in ([BinSize(10, 10)], [BinSize(8, 9), BinSize(16, 15), BinSize(40, 60)], [attention_cost(c) for c in (16, 64)]):
        most = max(s.capacity for s in sizes)
        lengths = sorted((rng.randrange(1, most + 1) for _ in range(300)), reverse=True)
        bins, places, capacities = pack(lengths, sizes)
        used = [0] * len(capacities)
        for b, p, length in zip(bins, places, lengths):
            assert p == used[b]
            used[b] += length
        assert (capacities, used) == plain_pack(lengths, sizes)


def test_pack_documents(docs_of):
    rng = random.Random(14)
    texts = [(k, prose(rng, rng.randrange(0, 70))) for k in range(300)] + [(400, None), (401, ""), (7, "a b"), (7, "a b"), (None, "c d e"), (402, "w " * 5000)]
    sizes = [attention_cost(c) for c in (16, 32, 64)]
    rows = pack_documents(docs_of(texts), word_count(F.col("text")), sizes, shard_pieces=64).collect()
    want, got = Counter(), Counter()
    for i, t in texts:
        want[str(i)] += len((t or "").split())
    for r in rows:
        got[str(r.doc_id)] += r.length
    assert +want == +got and {str(r.doc_id) for r in rows} == set(want)
    assert all(r.start == 64 * r.piece and (r.length == 64 or r.length < 64) for r in rows)
    bins = defaultdict(list)
    for r in rows:
        assert (r.bin is None) == (r.length == 0)
        if r.length:
            bins[r.bin].append((r.place, r.length, r.capacity))
    for held in bins.values():
        held.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(held, held[1:])) and held[0][0] == 0
        used, capacity = held[-1][0] + held[-1][1], held[0][2]
        assert capacity == min(c for c in (16, 32, 64) if c >= used)
    assert len({h[0][2] for h in bins.values()}) > 1
    assert pack_documents(docs_of(texts).limit(0), word_count(F.col("text")), sizes).count() == 0
    with pytest.raises(ValueError):
        pack_documents(docs_of(texts), word_count(F.col("text")), [])


def test_repeated_rows_fill_many_shards(docs_of):
    rows = pack_documents(docs_of([(1, "a b c")] * 200), word_count(F.col("text")), [BinSize(6, 6)], shard_pieces=16).collect()
    assert len(rows) == 200 and len({r.bin & 0xFFFFFFFF for r in rows}) > 4
    assert len({(r.bin, r.place) for r in rows}) == 200
