"""The registered queries and the pipeline on the smallest tables, against SQL or plain code."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_corpus import plain_components, plain_contamination, plain_pack, shingles
from test_urls_secrets import plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from check import difference, duck
from tidemark.llm.queries import BIN_SIZES, QUERIES, SQL
from tidemark.llm.secret_scan import KINDS, scan_batch
from tidemark.llm.toxicity import Restorer, learn_toxicity

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def rows_of(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_names():
    assert [int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op")] == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), SQL[name]) is None


def test_toxicity_holds_out(spark):
    got = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF_DIR).collect()}
    assert set(got) == {d["doc_id"] for d in rows_of("documents")}
    assert all(r.held_out == (crc(i) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    # 87 labels leave little to learn from: no clean document may suffer all the same.
    clean = [got[x["doc_id"]].predicted for x in rows_of("labels") if x["toxic"] == 0]
    assert not any(clean)


def test_languages_hold_out(spark):
    docs = {d["doc_id"]: d for d in rows_of("documents")}
    got = QUERIES["op6_language_id"](spark, SF_DIR).collect()
    assert len(got) == len(docs) and all(r.held_out == (crc(r.doc_id) % 5 == 0) for r in got)
    held = [r.lang_pred == docs[r.doc_id]["lang"] for r in got if r.held_out]
    assert sum(held) >= 0.95 * len(held)


def test_secrets_equal_expressions(spark):
    docs = {d["doc_id"]: d["text"] for d in rows_of("documents")}
    got = QUERIES["op7_secret_scans"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        spans = plain_spans(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_tokens_equal_library(spark):
    docs = {d["doc_id"]: d["text"] for d in rows_of("documents")}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op10_token_counts"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        tokens = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), tokens, tokens > 2048)


def check_packing(docs, rows):
    """One shard holds all of these documents, so that plain best-fit gives the same bins."""
    most = max(s.capacity for s in BIN_SIZES)
    pieces = []
    for doc in docs:
        words = len((doc["text"] or "").split())
        pieces += [(min(most, words - at), doc["doc_id"], at // most) for at in range(0, words, most)]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    capacities, used = plain_pack([p[0] for p in pieces], BIN_SIZES)
    assert Counter((r.length, r.doc_id, r.piece) for r in rows if r.length) == Counter(pieces)
    bins = defaultdict(int)
    for r in rows:
        if r.length:
            bins[r.bin, r.capacity] += r.length
    assert Counter((c, u) for (_, c), u in bins.items()) == Counter(zip(capacities, used))


def test_packing_equals_plain_best_fit(spark):
    check_packing(rows_of("documents"), QUERIES["op9_best_fit_packing"](spark, SF_DIR).collect())


def test_pipeline_equals_plain_stages(spark):
    """Every stage against plain code on what the stage before it kept."""
    docs = corpus_pipeline.table(spark, SF_DIR, "documents")
    model = learn_toxicity(docs, corpus_pipeline.table(spark, SF_DIR, "labels"))
    plain = rows_of("documents")
    expected = {}
    plain = [d for d in plain if model.scores(pa.array([d["text"]]), Restorer(model.trigrams))[0] < 0.7]
    expected["toxicity"] = plain
    group = {i: c for i, _, c in plain_components([(d["doc_id"], d["text"]) for d in plain])}
    plain = [d for d in plain if not shingles(d["text"]) or group[d["doc_id"]] == d["doc_id"]]
    expected["ngram_jaccard_join"] = plain
    items = [(str(x["item_id"]), x["text"]) for x in rows_of("benchmark")]
    plain = [d for d in plain if not plain_contamination(d["text"], items)[-1]]
    expected["benchmark_decontamination"] = plain
    masked = []
    for d in plain:
        text, done, out = d["text"], 0, []
        for begin, _, end in scan_batch(pa.array([text]))[0]:
            if begin >= done:
                out += [text[done:begin], "[secret]"]
            done = max(done, end)
        text = "".join([*out, text[done:]])
        masked.append(d | {"text": text, "n_chars": len(text)})
    expected["secret_scans"] = masked
    key = lambda d: d["doc_id"]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        if name in expected:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert sorted((r.asDict() for r in docs.collect()), key=key) == sorted(expected[name], key=key), name
    rows = docs.collect()
    check_packing(masked, rows)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, rows))


def test_pipeline_takes_odd_tables(spark, tmp_path):
    """Null ids and texts, empty and long texts, repeated rows and columns named like those of the stages."""
    rng = random.Random(31)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    near = prose(300)
    item = prose(40)
    texts = [(1, near), (2, near + " more"), (2, near + " more"), (None, prose(30)), (None, None), (5, None), (6, ""), (7, " \n"), (8, prose(30_000)),
             (9, prose(20) + " " + item), (10, "password: hunter22 " + prose(50)), (11, prose(60)), (11, prose(60))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, version long, once boolean, hash string, doubtful int, c0 int, bin long"
    rows = [(i, t, None, "s", None if t is None else len(t), 7, True, "h", 1, 2, 3) for i, t in texts]
    for name, df in {
        "documents": spark.createDataFrame(rows, schema),
        "labels": spark.createDataFrame([(1, 1, 0), (11, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([("b", item), (None, None), ("e", "")], "item_id string, text string"),
    }.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs, kept = corpus_pipeline.table(spark, str(tmp_path), "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        kept[name] = docs.collect()
        assert name == "best_fit_packing" or docs.columns == columns
    ids = lambda name: sorted((str(r.doc_id) for r in kept[name]))
    assert ids("toxicity") == sorted(str(i) for i, _ in texts)
    everything = sorted(str(i) for i, _ in texts)
    everything.remove("2"), everything.remove("2")
    assert ids("ngram_jaccard_join") == everything
    everything.remove("9")
    assert ids("benchmark_decontamination") == ids("secret_scans") == everything
    assert [r.text.split()[0] for r in kept["secret_scans"] if r.doc_id == 10] == ["[secret]"]
    assert {str(r.doc_id) for r in kept["best_fit_packing"]} >= {"1", "8", "10", "11", "None"}
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        corpus_pipeline.table(spark, str(tmp_path), name).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
