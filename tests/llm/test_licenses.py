"""Licence scans against every signature tried at every word."""

import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tidemark.llm.licenses import (
    BASE_PHRASES, TIER_SCORES, Detection, LicenseRule, LicenseScanner, license_report, license_rules, scan_licenses,
)
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
RULES = license_rules()
COMPILED = [re.compile(f"(?<= ){r.pattern}(?= )".encode()) for r in RULES]
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_scan(text, rules=RULES, compiled=COMPILED):
    """Number of words and detections left, by looking at all pairs of matches."""
    words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in text))
    line, starts = b" ", []
    for word in words:
        starts.append(len(line))
        line += word + b" "
    found = []
    for start, begin in enumerate(starts):
        for k, pattern in enumerate(compiled):
            match = pattern.match(line, begin)
            if match:
                found.append(Detection(start, start + match.group().count(b" ") + 1, k))

    def beaten(one, by):
        if rules[by.rule].pinned or rules[one.rule].pinned or one == by:
            return False
        size, tier = lambda d: d.end - d.start, lambda d: rules[d.rule].tier
        inside = by.start <= one.start and one.end <= by.end
        return inside and (tier(by), -size(by), by.rule) < (tier(one), -size(one), one.rule)

    return len(words), sorted(d for d in found if not any(beaten(d, by) for by in found))


def test_rules_are_hundreds_with_keywords():
    assert len(RULES) > 300 and len({(r.label, r.pattern) for r in RULES}) == len(RULES)
    for rule in RULES:
        if not rule.before:
            assert rule.pattern.startswith(rule.keyword)


def example(pattern):
    """Words that a signature fits, more or less: first alternatives, most of what is optional."""
    for part, plain in ((r"\(\?!.*?\)", ""), (r"\[(.)[^]]*\]", r"\1"), (r"\\d", "2"), (r"\\[wS]\+?", "x"), (r"\{[^}]*\}|[?*](?!:)", "")):
        pattern = re.sub(part, plain, pattern)
    for _ in range(3):
        pattern = re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", pattern)
    return pattern


def test_scan_equals_all_signatures():
    rng = random.Random(1)
    parts = [example(r.pattern) for r in RULES]
    texts = [b"", b" ", b"cc", b"by cc by cc by", "É all rights reserved ".encode(), b"SPDX-License-Identifier: MIT"]
    texts += [b"licensed under the GNU General Public License, version 3. (C) 2020 All rights\nReserved", b"all rights reserved " * 30]
    for _ in range(150):
        words = [w for _ in range(rng.randrange(6)) for w in rng.choice([rng.choice(parts), "x1", "license", "(c) 2019, 20"]).split()]
        if words and rng.random() < 0.3:
            words.pop(rng.randrange(len(words)))
        texts.append(rng.choice(["-", " ", ",\n"]).join(words).encode())
    texts += [part.encode() for part in parts]
    got = LicenseScanner(RULES).scan(texts)
    assert got == [plain_scan(text) for text in texts]
    assert sum(len(d) for _, d in got) > 200


def test_tiers_and_containment():
    rules = [LicenseRule("a", "a b", "a b c", 1), LicenseRule("b", "b", "b", 0), LicenseRule("c", "b", "b c", 1), LicenseRule("d", "b", "b", 3, pinned=True),
             LicenseRule("e", "b", "b", 0), LicenseRule("f", "c", "b c d", 2, before=1)]
    compiled = [re.compile(f"(?<= ){r.pattern}(?= )".encode()) for r in rules]
    n, found = LicenseScanner(rules).scan([b"a b c d"])[0]
    # The short one of the best tier stays, the longer one of tier 1 hides "b c", "b c d" only overlaps.
    assert (n, [rules[d.rule].label for d in found]) == (4, ["a", "b", "d", "f"])
    assert (n, found) == plain_scan(b"a b c d", rules, compiled)


def test_rows(spark, docs_of):
    text = "All rights reserved. Licensed under CC BY-NC 4.0; all rights RESERVED"
    docs = docs_of([(1, text), (1, text), (None, "gpl"), (2, None), (3, ""), (4, "the MIT license " * 20_000), (5, "see gnu.org/licenses/gpl-3.0")])
    rows = {(r.doc_id, r.n_words): r for r in license_report(scan_licenses(docs)).collect()}
    first = rows[1, 13]
    assert (first.n_base, first.first_word, first.last_word) == (3, 0, 10)
    assert (first.base_labels, first.labels, first.score) == ("cc-by,reserved", "cc-by,cc-by-nc,reserved", TIER_SCORES[1])
    for key in ((2, 0), (3, 0), (None, 1)):
        assert (rows[key].n_base, rows[key].first_word, rows[key].labels, rows[key].score) == (0, None, "", 0.0)
    assert (rows[4, 60_000].labels, rows[4, 60_000].n_base) == ("mit", 0)
    assert rows[5, 7].labels == "gpl" and rows[5, 7].score == TIER_SCORES[0]
    assert scan_licenses(docs).count() == 7 and license_report(scan_licenses(docs.limit(0))).count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_query_equals_all_signatures(spark):
    docs = {d["doc_id"]: (d["text"] or "").encode() for d in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()}
    got = QUERIES["op12_license_scans"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    phrases = [(p.encode().split(), label) for p, label in BASE_PHRASES]
    for r in got:
        n, found = plain_scan(docs[r.doc_id])
        words = WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in docs[r.doc_id]))
        base = [(k, label) for k in range(n) for phrase, label in phrases if words[k : k + len(phrase)] == phrase]
        starts = [k for k, _ in base] or [None]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), starts[0], starts[-1])
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert r.labels == ",".join(sorted({RULES[d.rule].label for d in found}))
        assert r.score == (TIER_SCORES[min(RULES[d.rule].tier for d in found)] if found else 0)
