"""The corpus operators over the supplied tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import find_contamination
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.language import identify_languages
from tidemark.llm.licenses import license_report, scan_licenses
from tidemark.llm.packing import attention_cost, pack_documents, word_count
from tidemark.llm.periodic import find_runs, plant_runs, run_digests
from tidemark.llm.quality import POLICIES, RULE_NAMES, ablations, apply_policy, mask_of, measure
from tidemark.llm.secret_scan import scan_secrets
from tidemark.llm.spelling import misspelled, spelling_variants
from tidemark.llm.token_count import count_tokens
from tidemark.llm.toxicity import score_toxicity
from tidemark.llm.warc import round_trip
from tidemark.llm.wildcards import UrlRule, judge_urls, prefix_rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


#: The stated rules, then globs that judge urls which no stated rule fits.
URL_RULES = (
    *prefix_rules("allow", "org/"),
    *prefix_rules("block", "example.org/es/"),
    *prefix_rules("block", "example.org/en/1"),
    *prefix_rules("allow", "com/fr/"),
    *prefix_rules("block", "com/de/"),
    UrlRule("block", "*.xyz/**"),
    UrlRule("block", "ads.*/**"),
    UrlRule("block", "*/**login**"),
    UrlRule("block", "m.*.net/de/**"),
    UrlRule("block", "*.net/es/?"),
)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("glob")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_policy(measure(table(spark, sf_dir, "documents")), POLICIES["v2"]).drop("n_lines")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that each policy of op8 keeps without one of its rules, counted from the ledger."""
    return ablations(measure(table(spark, sf_dir, "documents")))


#: Permitted sequence lengths, in words.
BIN_SIZES = tuple(attention_cost(capacity) for capacity in (512, 1024, 2048, 4096))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_count(F.col("text")), BIN_SIZES)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(find_runs(plant_runs(table(spark, sf_dir, "documents"))))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(scan_licenses(table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), edit=misspelled)


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_toxicity": op3_toxicity,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_url_filters": op5_url_filters,
    "op6_language_id": op6_language_id,
    "op7_secret_scans": op7_secret_scans,
    "op8_quality_rules": op8_quality_rules,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scans": op12_license_scans,
    "op13_spelling_variants": op13_spelling_variants,
    "quality_ablations": quality_ablations,
}

#: The 256 steps of a crc32, as a list of one row.
CRC_STEPS = """steps AS (
  SELECT i AS start, i AS v, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT start, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(v ORDER BY start) AS t FROM steps WHERE k = 8)"""


def crc_of(text: str) -> str:
    """SQL for the crc32 of the UTF-8 of a text, next to a table ``crc``."""
    data = f"list_transform(range(0, octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS INT), 2) AS BIGINT))"
    step = "lambda a, b: xor(a >> 8, crc.t[CAST(xor(a, b) & 255 AS INT) + 1])"
    return f"xor(list_reduce(list_concat([4294967295], {data}), {step}), 4294967295)"

SQL = {
    "op1_benchmark_decontamination": r"""
WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT item, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), sizes AS (SELECT list(DISTINCT size) AS sizes FROM windows),
starts AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
  FROM (SELECT doc_id, words, unnest(sizes) AS size FROM docs, sizes)
), found AS (
  SELECT DISTINCT s.doc_id, s.i, s.size, w.item
  FROM (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w FROM starts) s JOIN windows w ON w.w = s.w AND w.size = s.size
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)""",
    "op2_warc_round_trip": """
WITH digests AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), letters AS (
  SELECT *, list_transform(range(0, 32), lambda k:
    (CAST('0x' || substr(hex, CAST(k // 4 AS INT) * 5 + 1, 5) AS INTEGER) >> (15 - 5 * CAST(k % 4 AS INT))) & 31) AS fives,
    max(page_id) OVER (PARTITION BY hex) AS newest
  FROM digests
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to, TRUE AS intact
FROM letters""",
    "op4_ngram_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(x.n) + any_value(y.n) AS n, count(*) AS o
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  WHERE 4 * x.n >= 3 * y.n AND 4 * y.n >= 3 * x.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM sizes
  UNION
  SELECT l.u, reach.r FROM reach JOIN links l ON l.v = reach.doc_id
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)""",
    "op5_url_filters": r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN suffix(host, '.xyz') AND starts_with(path, '/') THEN 'block'
  WHEN starts_with(host, 'ads.') AND starts_with(path, '/') THEN 'block'
  WHEN starts_with(path, '/') AND contains(path, 'login') THEN 'block'
  WHEN starts_with(host, 'm.') AND suffix(substr(host, 3), '.net') AND starts_with(path, '/de/') THEN 'block'
  WHEN suffix(host, '.net') AND regexp_full_match(path, '/es/[^/]', 's') THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled""",
    "op8_quality_rules": r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)
), twins AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM starts) WHERE n > 1
), again AS (
  SELECT doc_id, sum(least(5, coalesce(j - i, 5))) AS n FROM twins GROUP BY doc_id
), measured AS (
  SELECT s.doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(a.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN again a USING (doc_id)
), bits AS (
  SELECT *, CAST(
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 20 * word_chars THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 30 * n_words THEN 32 ELSE 0 END AS INTEGER) AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, failed & 3 <> 0 AS base_failed, failed & 47 = 0 AS kept
FROM bits""",
    "op11_periodic_runs": f"""
WITH RECURSIVE {CRC_STEPS}, hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {crc_of("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc
), sized AS (
  SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed
), planted AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w
  FROM sized
), starts AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM (SELECT *, unnest(range(0, n - 5)) AS i FROM planted WHERE n > 5)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM starts x JOIN starts y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i AND 2 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM pairs) GROUP BY doc_id, q, stretch
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= 2 * q AND length >= 12 GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, p := period), (-length, start, period)) AS best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id
), repeated AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
gone AS (SELECT doc_id, list(i) AS places FROM repeated GROUP BY doc_id),
remaining AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept
  FROM (SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS word FROM planted WHERE doc_id IN (SELECT doc_id FROM gone)) p
  ANTI JOIN repeated r ON r.doc_id = p.doc_id AND r.i = p.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, l.best.s AS start, l.best.l AS length, l.best.p AS period,
  1000 * l.best.l // l.best.p AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
  sha256(coalesce(s.kept, array_to_string(d.w, ' '))) AS collapsed_sha256
FROM planted d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN remaining s ON s.doc_id = d.doc_id""",
    "op13_spelling_variants": f"""
WITH RECURSIVE {CRC_STEPS}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc_of("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM counted, crc),
edited AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
  SELECT DISTINCT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), links AS (
  SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT s.word, w.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
), best AS (
  SELECT l.word, count(*) AS n_near, arg_min(l.near, (-w.n, encode(l.near))) AS near, max(w.n) AS near_n
  FROM links l JOIN words w ON w.word = l.near GROUP BY l.word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 5 * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= 5 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL""",
}

_CASES = [
    (policy, bits, rule, 0 if rule is None else mask_of(rule))
    for policy, bits in POLICIES.items()
    for rule in (None, *(r for r in RULE_NAMES if bits & mask_of(r)))
]
SQL["quality_ablations"] = f"""
WITH ledger AS ({SQL["op8_quality_rules"]})
{" UNION ALL ".join(f"""
SELECT '{policy}' AS policy, {f"'{rule}'" if rule else "CAST(NULL AS VARCHAR)"} AS without,
  count(*) FILTER (WHERE failed & {bits & ~bit} = 0) AS kept,
  count(*) FILTER (WHERE failed & {bits & ~bit} = 0 AND failed & {bits} <> 0) AS only_here
FROM ledger""" for policy, bits, rule, bit in _CASES)}"""
