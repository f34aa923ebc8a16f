"""Licence notices in texts: ordered signature rules behind a keyword automaton.

A text becomes its words in lower case with one space between, so a signature need not care
for punctuation or line breaks. One Aho-Corasick pass finds the keywords of all rules; only
rules whose keyword occurs are tried, each from its keyword's places on. Every rule has a tier:
a detection inside that of a better or equal tier is suppressed, the rules' order decides ties.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_view, chunks


class LicenseRule(NamedTuple):
    """A signature over words with one space between; it begins with the keyword, or within ``before`` words of it."""

    label: str
    keyword: str
    pattern: str
    tier: int
    before: int = 0
    #: Never suppressed.
    pinned: bool = False


#: How much a detection of each tier is worth: tags and links, grants, full names, short names.
TIER_SCORES = (0.99, 0.9, 0.75, 0.5)

# The phrases that are always found, and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Labels of licences and their identifiers, as words.
IDENTIFIERS = {
    "agpl": ("agpl 1 0", "agpl 3 0"),
    "apache": ("apache 1 0", "apache 1 1", "apache 2 0"),
    "artistic": ("artistic 1 0", "artistic 2 0"),
    "bsd": ("0bsd", "bsd 1 clause", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause"),
    "bsl": ("bsl 1 0", "busl 1 1"),
    "cc-by": ("cc by 1 0", "cc by 2 0", "cc by 2 5", "cc by 3 0", "cc by 4 0"),
    "cc-by-nc": ("cc by nc 2 0", "cc by nc 3 0", "cc by nc 4 0"),
    "cc-by-nc-nd": ("cc by nc nd 2 0", "cc by nc nd 3 0", "cc by nc nd 4 0"),
    "cc-by-nc-sa": ("cc by nc sa 2 0", "cc by nc sa 3 0", "cc by nc sa 4 0"),
    "cc-by-nd": ("cc by nd 2 0", "cc by nd 3 0", "cc by nd 4 0"),
    "cc-by-sa": ("cc by sa 2 0", "cc by sa 3 0", "cc by sa 4 0"),
    "cc0": ("cc0 1 0",),
    "cddl": ("cddl 1 0", "cddl 1 1"),
    "cecill": ("cecill 1 0", "cecill 2 0", "cecill 2 1", "cecill b", "cecill c"),
    "cpl": ("cpl 1 0",),
    "epl": ("epl 1 0", "epl 2 0"),
    "eupl": ("eupl 1 0", "eupl 1 1", "eupl 1 2"),
    "gfdl": ("gfdl 1 1", "gfdl 1 2", "gfdl 1 3"),
    "gpl": ("gpl 1 0", "gpl 2 0", "gpl 3 0"),
    "isc": ("isc",),
    "lgpl": ("lgpl 2 0", "lgpl 2 1", "lgpl 3 0"),
    "mit": ("mit", "mit 0", "mit cmu", "x11"),
    "mpl": ("mpl 1 0", "mpl 1 1", "mpl 2 0"),
    "ms": ("ms pl", "ms rl"),
    "ncsa": ("ncsa",),
    "odbl": ("odbl 1 0", "odc by 1 0", "pddl 1 0"),
    "ofl": ("ofl 1 0", "ofl 1 1"),
    "openssl": ("openssl",),
    "osl": ("osl 1 0", "osl 2 0", "osl 2 1", "osl 3 0", "afl 3 0"),
    "postgresql": ("postgresql",),
    "psf": ("psf 2 0", "python 2 0"),
    "ruby": ("ruby",),
    "unlicense": ("unlicense",),
    "upl": ("upl 1 0",),
    "vim": ("vim",),
    "wtfpl": ("wtfpl",),
    "zlib": ("zlib", "libpng 2 0"),
    "zpl": ("zpl 1 1", "zpl 2 0", "zpl 2 1"),
}

# Addresses of licence texts, as words.
LINKS = {
    "agpl": ("gnu org licenses agpl", "opensource org licenses agpl"),
    "apache": ("apache org licenses license 2 0", "apache org licenses", "opensource org licenses apache 2 0"),
    "bsd": ("opensource org licenses bsd license", "opensource org licenses bsd 2 clause", "opensource org licenses bsd 3 clause"),
    "cc-by": ("creativecommons org licenses by 1 0", "creativecommons org licenses by 2 0", "creativecommons org licenses by 3 0",
              "creativecommons org licenses by 4 0"),
    "cc-by-nc": ("creativecommons org licenses by nc 2 0", "creativecommons org licenses by nc 3 0", "creativecommons org licenses by nc 4 0"),
    "cc-by-nc-nd": ("creativecommons org licenses by nc nd",),
    "cc-by-nc-sa": ("creativecommons org licenses by nc sa",),
    "cc-by-nd": ("creativecommons org licenses by nd",),
    "cc-by-sa": ("creativecommons org licenses by sa",),
    "cc0": ("creativecommons org publicdomain zero", "creativecommons org publicdomain mark"),
    "eupl": ("joinup ec europa eu software page eupl",),
    "epl": ("eclipse org legal epl", "eclipse org org documents epl"),
    "gfdl": ("gnu org licenses fdl", "gnu org copyleft fdl"),
    "gpl": ("gnu org licenses gpl", "gnu org copyleft gpl", "gnu org licenses old licenses gpl", "opensource org licenses gpl"),
    "isc": ("opensource org licenses isc",),
    "lgpl": ("gnu org licenses lgpl", "gnu org copyleft lesser", "gnu org licenses old licenses lgpl", "opensource org licenses lgpl"),
    "mit": ("opensource org licenses mit", "opensource org license mit"),
    "mpl": ("mozilla org mpl", "opensource org licenses mpl"),
    "odbl": ("opendatacommons org licenses",),
    "ofl": ("scripts sil org ofl", "openfontlicense org"),
    "unlicense": ("unlicense org",),
    "wtfpl": ("wtfpl net", "sam zoy org wtfpl"),
    "zlib": ("zlib net zlib license", "opensource org licenses zlib"),
}

# Hand-written signatures of grants and conditions: label, keyword, expression, words before the keyword.
GRANTS = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy", 0),
    ("mit", "the above copyright notice and this permission", r"the above copyright notice and this permission notice shall be included in all", 0),
    ("isc", "permission to use copy modify", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee", 0),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification are permitted", 0),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice", 0),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice", 0),
    ("bsd", "neither the name of", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors", 0),
    ("apache", "licensed under the apache", r"licensed under the apache licen[cs]e(?: version)?(?: \d)?(?: \d)?", 0),
    ("apache", "under the apache license", r"(?:released|distributed|available|published) under the apache license(?: version)?(?: \d)?(?: \d)?", 1),
    ("gpl", "gnu general public", r"(?:licensed|released|distributed|available|published) under the (?:terms of the )?gnu general public licen[cs]e"
            r"(?: (?:v|version )?\d(?: \d)?)?", 6),
    ("gpl", "under the terms of the gnu general", r"under the terms of the gnu general public licen[cs]e(?: as published by the free software foundation)?", 0),
    ("gpl", "either version", r"either version [123](?: of the license)? or at your option any later version", 0),
    ("lgpl", "under the terms of the gnu lesser", r"under the terms of the gnu lesser general public licen[cs]e", 0),
    ("lgpl", "under the terms of the gnu library", r"under the terms of the gnu library general public licen[cs]e", 0),
    ("agpl", "under the terms of the gnu affero", r"under the terms of the gnu affero general public licen[cs]e", 0),
    ("mpl", "subject to the terms of the mozilla", r"subject to the terms of the mozilla public licen[cs]e(?: v)?(?: \d)?(?: \d)?", 0),
    ("mpl", "mozilla public", r"(?:licensed|released|distributed|available) under the mozilla public licen[cs]e(?: (?:v|version )?\d(?: \d)?)?", 4),
    ("mit", "mit license", r"(?:licensed|released|distributed|available|published) under the (?:terms of the )?mit license", 6),
    ("mit", "mit licence", r"(?:licensed|released|distributed|available|published) under the (?:terms of the )?mit licence", 6),
    ("bsd", "bsd license", r"(?:licensed|released|distributed|available|published) under (?:the |a )?(?:\w+ clause )?bsd license", 6),
    ("cc-by-nc", "licensed under cc by nc", r"licensed under cc by nc(?: \d \d)?(?! sa| nd)", 0),
    ("cc-by-nc-sa", "licensed under cc by nc sa", r"licensed under cc by nc sa(?: \d \d)?", 0),
    ("cc-by-nc-nd", "licensed under cc by nc nd", r"licensed under cc by nc nd(?: \d \d)?", 0),
    ("cc-by-sa", "licensed under cc by sa", r"licensed under cc by sa(?: \d \d)?", 0),
    ("cc-by-nd", "licensed under cc by nd", r"licensed under cc by nd(?: \d \d)?", 0),
    ("cc-by", "licensed under cc by", r"licensed under cc by(?: \d \d)?(?! nc| sa| nd)", 0),
    ("cc", "under a creative commons", r"under a creative commons (?:\S+ ){0,6}licen[cs]e", 0),
    ("cc0", "to the extent possible under law", r"to the extent possible under law (?:\S+ ){1,12}waived all copyright", 0),
    ("public-domain", "released into the public domain", r"released into the public domain", 0),
    ("public-domain", "placed in the public domain", r"(?:hereby )?placed in the public domain", 1),
    ("public-domain", "this is in the public domain", r"this is in the public domain", 0),
    ("unlicense", "this is free and unencumbered", r"this is free and unencumbered software released into the public domain", 0),
    ("wtfpl", "do what the", r"do what the \S+ you want to", 0),
    ("zlib", "this software is provided as is", r"this software is provided as is without any express or implied warranty in no event will the authors", 0),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such", 0),
    ("epl", "accompanying materials are made available under", r"accompanying materials are made available under the terms of the eclipse public licen[cs]e", 0),
    ("ofl", "sil open font", r"(?:licensed|released|distributed|available) under the sil open font license", 4),
    ("bsl", "boost software", r"(?:licensed|released|distributed|available) under the boost software license", 4),
    ("eupl", "european union public", r"(?:licensed|released|distributed|available) under the european union public licen[cs]e", 4),
    ("artistic", "same terms as perl", r"(?:under )?the same terms as perl itself", 2),
    ("ruby", "same terms as ruby", r"(?:under )?the same terms as ruby", 2),
    ("psf", "python software foundation", r"(?:licensed|released|distributed) under the python software foundation license", 4),
    ("warranty", "without warranty of any kind", r"(?:provided as is )?without warranty of any kind(?: express or implied)?", 3),
    ("warranty", "without any warranty", r"without any warranty(?: without even the implied warranty of merchantability)?", 0),
    ("warranty", "warranties of merchantability", r"warranties of merchantability(?: and)? fitness for a particular purpose", 0),
    ("no-reuse", "may not be", r"may not be (?:reproduced|copied|published|redistributed)", 0),
    ("no-reuse", "no part of this", r"no part of this (?:publication|book|document|work|site) may be reproduced", 0),
    ("no-reuse", "without prior written", r"without prior written (?:permission|consent)", 0),
    ("no-reuse", "without the prior written", r"without the prior written (?:permission|consent)", 0),
    ("no-reuse", "for personal", r"for personal(?: and)? (?:non commercial )?use only", 0),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", 0),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary", 0),
    ("proprietary", "unauthorized copying", r"unauthorized copying of (?:this|these|the) \S+", 0),
    ("proprietary", "commercial license agreement", r"(?:subject to|under) (?:a|the) commercial license agreement", 3),
    ("eula", "end user license agreement", r"end user license agreement", 0),
    ("copyright", "copyright c", r"copyright c(?: (?:19|20)\d\d(?: (?:19|20)?\d\d)*)?", 0),
    ("copyright", "copyright 19", r"copyright 19\d\d(?: (?:19|20)?\d\d)*", 0),
    ("copyright", "copyright 20", r"copyright 20\d\d(?: (?:19|20)?\d\d)*", 0),
)

# Hand-written full names: label and expression; the keyword is the plain text it begins with.
NAMES = (
    ("agpl", r"gnu affero general public licen[cs]e"), ("agpl", r"affero general public licen[cs]e"),
    ("apache", r"apache license(?: version)?(?: \d)?(?: \d)?"), ("apache", r"apache software license(?: \d)?(?: \d)?"),
    ("artistic", r"artistic license(?: \d)?(?: \d)?"), ("artistic", r"perl artistic license"),
    ("beerware", r"beer ware license"), ("beerware", r"beerware license"),
    ("bsd", r"bsd license"), ("bsd", r"bsd licence"), ("bsd", r"bsd style license"), ("bsd", r"simplified bsd"), ("bsd", r"modified bsd"),
    ("bsd", r"new bsd license"), ("bsd", r"revised bsd"), ("bsl", r"boost software license"), ("bsl", r"business source license"),
    ("cc-by", r"creative commons attribution(?: \d \d)?(?! (?:non|share|no))"),
    ("cc-by-nc", r"creative commons attribution non ?commercial(?: \d \d)?(?! (?:share|no))"),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv\w+"),
    ("cc-by-sa", r"creative commons attribution share ?alike"), ("cc-by-nd", r"creative commons attribution no ?deriv\w+"),
    ("cc0", r"creative commons zero"), ("cc0", r"cc0 universal"), ("cddl", r"common development and distribution licen[cs]e"),
    ("cecill", r"cecill free software license"), ("cpl", r"common public license"), ("cpal", r"common public attribution license"),
    ("ecl", r"educational community license"), ("efl", r"eiffel forum license"), ("epl", r"eclipse public licen[cs]e"),
    ("edl", r"eclipse distribution license"), ("eupl", r"european union public licen[cs]e"), ("fair", r"fair license"),
    ("fdl", r"freebsd documentation license"), ("gfdl", r"gnu free documentation licen[cs]e"),
    ("gpl", r"gnu general public licen[cs]e(?: (?:v|version )?\d(?: \d)?)?"), ("gpl", r"gnu public license"),
    ("hpnd", r"historical permission notice and disclaimer"), ("ijg", r"independent jpeg group"), ("ipl", r"ibm public license"),
    ("isc", r"isc license"), ("isc", r"isc licence"), ("jasper", r"jasper license"), ("json", r"json license"),
    ("lgpl", r"gnu lesser general public licen[cs]e"), ("lgpl", r"gnu library general public licen[cs]e"),
    ("lgpl", r"lesser general public licen[cs]e"), ("lppl", r"latex project public license"), ("lpl", r"lucent public license"),
    ("mit", r"mit license"), ("mit", r"mit licence"), ("mit", r"mit x11"), ("mit", r"x11 license"), ("mit", r"expat license"),
    ("mpl", r"mozilla public licen[cs]e(?: (?:v|version )?\d(?: \d)?)?"), ("ms", r"microsoft public license"),
    ("ms", r"microsoft reciprocal license"), ("mulan", r"mulan permissive software license"), ("nasa", r"nasa open source agreement"),
    ("ncsa", r"university of illinois ncsa"), ("npl", r"netscape public license"), ("odbl", r"open database licen[cs]e"),
    ("odbl", r"open data commons"), ("ofl", r"sil open font license"), ("ofl", r"open font license"), ("ogl", r"open government licen[cs]e"),
    ("opl", r"open publication license"), ("openrail", r"openrail m?"), ("openssl", r"openssl license"), ("osl", r"open software license"),
    ("osl", r"academic free license"), ("php", r"php license"), ("postgresql", r"postgresql licen[cs]e"), ("psf", r"python software foundation license"),
    ("psf", r"psf license"), ("public-domain", r"public domain dedication"), ("qpl", r"q public license"), ("rpl", r"reciprocal public license"),
    ("rpsl", r"realnetworks public source license"), ("ruby", r"ruby license"), ("sissl", r"sun industry standards source license"),
    ("sleepycat", r"sleepycat license"), ("sspl", r"server side public license"), ("tcl", r"tcl tk license"), ("unicode", r"unicode license"),
    ("unlicense", r"the unlicense"), ("upl", r"universal permissive license"), ("vim", r"vim license"), ("w3c", r"w3c software notice and license"),
    ("watcom", r"sybase open watcom"), ("wtfpl", r"wtfpl license"), ("xnet", r"x net license"), ("zend", r"zend engine license"),
    ("zlib", r"zlib license"), ("zlib", r"zlib libpng"), ("zpl", r"zope public license"),
)

# Hand-written short names and other hints: label and expression.
HINTS = (
    ("agpl", r"agplv3"), ("apache", r"asl 2 0"), ("apache", r"apache 2 0"), ("cc", r"creative commons"), ("cc-by-nc", r"cc by nc(?: \d \d)?(?! (?:sa|nd))"),
    ("cc-by-nc-nd", r"cc by nc nd(?: \d \d)?"), ("cc-by-nc-sa", r"cc by nc sa(?: \d \d)?"), ("cc-by-nd", r"cc by nd(?: \d \d)?"),
    ("cc-by-sa", r"cc by sa(?: \d \d)?"), ("cc0", r"cc0"), ("copyleft", r"copyleft"), ("gpl", r"gplv2"), ("gpl", r"gplv3"), ("gpl", r"gnu gpl"),
    ("gpl", r"gpl compatible"), ("lgpl", r"lgplv2"), ("lgpl", r"lgplv3"), ("lgpl", r"gnu lgpl"), ("open-source", r"open source license"),
    ("proprietary", r"proprietary license"), ("public-domain", r"public domain"), ("royalty-free", r"royalty free"), ("reserved", r"some rights reserved"),
    ("reserved", r"no rights reserved"), ("trademark", r"registered trademark"),
)


def _literal(pattern: str) -> str:
    """The whole words a signature begins with; they are its keyword."""
    plain = re.match(r"[a-z0-9 ]+", pattern).group()
    cut = plain if len(plain) == len(pattern) or pattern[len(plain)] == "(" and not plain.endswith(" ") else plain.rpartition(" ")[0]
    return cut.strip()


def license_rules() -> tuple[LicenseRule, ...]:
    """All rules in order: stated phrases, identifier tags, links, grants, full names, short names."""
    rules = [LicenseRule(label, phrase, phrase, len(TIER_SCORES) - 1, pinned=True) for phrase, label in BASE_PHRASES]
    for label, names in IDENTIFIERS.items():
        for name in names:
            tag = f"spdx license identifier {name}"
            rules.append(LicenseRule(label, tag, f"{tag}(?: only| or later)?", 0))
    for label, places in LINKS.items():
        rules += [LicenseRule(label, place, place, 0) for place in places]
    rules += [LicenseRule(label, keyword, pattern, 1, before) for label, keyword, pattern, before in GRANTS]
    rules += [LicenseRule(label, _literal(pattern), pattern, 2) for label, pattern in NAMES]
    rules += [LicenseRule(label, _literal(pattern), pattern, 3) for label, pattern in HINTS]
    return tuple(rules)


class Detection(NamedTuple):
    """A place in words, its end exclusive."""

    start: int
    end: int
    rule: int


class LicenseScanner:
    """The automaton over the keywords and the compiled signatures of some rules."""

    def __init__(self, rules: Iterable[LicenseRule]) -> None:
        self.rules = tuple(rules)
        self.by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            self.by_keyword.setdefault(f" {rule.keyword}", []).append(k)
        self.automaton = ahocorasick.Automaton()
        for keyword in self.by_keyword:
            self.automaton.add_word(keyword, keyword)
        self.automaton.make_automaton()
        self.patterns: dict[int, re.Pattern] = {}

    def _pattern(self, k: int) -> re.Pattern:
        if k not in self.patterns:
            self.patterns[k] = re.compile(f"(?<= ){self.rules[k].pattern}(?= )".encode())
        return self.patterns[k]

    def matches(self, raw: bytes) -> list[tuple[int, int, int]]:
        """``(begin, end, rule)`` in bytes of all matches, in texts of words with one space around each word.

        A place is tried once for a rule. A match is the longest its signature takes from
        its place; matches of one rule that begin at different places may overlap.
        """
        places: dict[str, list[int]] = {}
        for last, keyword in self.automaton.iter(raw.decode("latin-1")):
            places.setdefault(keyword, []).append(last + 2 - len(keyword))
        found = []
        for keyword, some in places.items():
            for k in self.by_keyword[keyword]:
                pattern, before, tried = self._pattern(k), self.rules[k].before, -1
                for place in some:
                    begins = [place]
                    for _ in range(before):
                        begin = raw.rfind(b" ", 0, begins[-1] - 1) + 1
                        # Two spaces or a line break are the edge of a text.
                        if begin >= begins[-1] - 1 or raw[begin : begin + 1] == b"\n":
                            break
                        begins.append(begin)
                    for begin in reversed(begins):
                        if begin <= tried:
                            continue
                        tried = begin
                        match = pattern.match(raw, begin)
                        if match and match.end() > place:
                            found.append((begin, match.end(), k))
        return sorted(found)

    def suppressed(self, detections: list[Detection]) -> list[Detection]:
        """Detections without those inside another one of a better or the same tier; pinned ones stay.

        Of equal places in one tier the first rule stays. Sorted by start, then from the
        longest on, whatever contains a detection comes before it, so the furthest end
        of each tier is all that has to be remembered.
        """
        tier = [rule.tier for rule in self.rules]
        furthest, kept = [-1] * len(TIER_SCORES), []
        for one in sorted(detections, key=lambda d: (d.start, -d.end, tier[d.rule], d.rule)):
            if self.rules[one.rule].pinned or max(furthest[: tier[one.rule] + 1]) < one.end:
                kept.append(one)
            # A phrase that is always found suppresses nothing but is itself a detection of its tier.
            if not self.rules[one.rule].pinned:
                furthest[tier[one.rule]] = max(furthest[tier[one.rule]], one.end)
        return sorted(kept)

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[Detection]]]:
        """The number of words of each text and its detections by start, end and rule."""
        lines = [b" ".join(text.translate(_WORD_BYTES).split()) for text in texts]
        raw = b"".join(b" " + line + b" \n" for line in lines)
        found: list[list[Detection]] = [[] for _ in lines]
        matches = self.matches(raw)
        if matches:
            data = np.frombuffer(raw, np.uint8)
            line_ends = np.flatnonzero(data == 10)
            spaces = np.flatnonzero(data == 32)
            begins, ends, rules = (np.array(column) for column in zip(*matches))
            rows = np.searchsorted(line_ends, begins)
            first = np.searchsorted(spaces, np.concatenate([[0], line_ends + 1]))[rows]
            starts = np.searchsorted(spaces, begins) - 1 - first
            stops = np.searchsorted(spaces, ends) - first
            for row, *place in zip(rows.tolist(), starts.tolist(), stops.tolist(), rules.tolist()):
                found[row].append(Detection(*place))
        return [(line.count(b" ") + bool(line), self.suppressed(some)) for line, some in zip(lines, found)]


# A-Z in lower case; what is not of a word becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_DETECTIONS = "array<struct<start: bigint, end: bigint, rule: int, label: string, tier: int, pinned: boolean>>"


def scan_licenses(
    docs: DataFrame, rules: Iterable[LicenseRule] | None = None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_words, detections)``, one row per document.

    ``detections`` are places in words, numbered from 0, ends exclusive, by start, end and rule:
    those that no other one suppresses, and those of pinned rules. Words are runs of
    digits, letters a to z and characters beyond ASCII, with A-Z in lower case. A null
    or empty text has no words and no detections; null ids and repeated rows are like any
    others, and no other column is read.
    """
    id_type, rules = docs.schema[id_col].dataType.simpleString(), tuple(license_rules() if rules is None else rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(rules)
        for batch in chunks(batches, 1):
            data, offsets = byte_view(batch.column(1))
            raw, ends = data.tobytes(), offsets.tolist()
            scanned = scanner.scan([raw[begin:end] for begin, end in zip(ends, ends[1:])])
            flat = [d for _, some in scanned for d in some]
            sizes = np.cumsum([0, *(len(some) for _, some in scanned)])
            fields = {
                "start": pa.array([d.start for d in flat], pa.int64()),
                "end": pa.array([d.end for d in flat], pa.int64()),
                "rule": pa.array([d.rule for d in flat], pa.int32()),
                "label": pa.array([rules[d.rule].label for d in flat], pa.string()),
                "tier": pa.array([rules[d.rule].tier for d in flat], pa.int32()),
                "pinned": pa.array([rules[d.rule].pinned for d in flat], pa.bool_()),
            }
            places = pa.StructArray.from_arrays(list(fields.values()), list(fields))
            columns = [
                batch.column(0),
                pa.array([n for n, _ in scanned], pa.int64()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), places),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "detections"])

    return docs.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {id_type}, n_words long, detections {_DETECTIONS}")


def _labels(places: str) -> Column:
    return F.expr(f"array_join(array_sort(array_distinct(transform({places}, d -> d.label))), ',')")


def license_report(found: DataFrame) -> DataFrame:
    """``detections`` as counts, labels and a score.

    The score is that of the best tier found, 0 without any detection.
    """
    tiers = ", ".join(f"{score}D" for score in TIER_SCORES)
    others = [c for c in found.columns if c not in ("n_words", "detections")]
    base = F.expr("filter(detections, d -> d.pinned)").alias("base")
    return found.select(*others, "n_words", "detections", base).select(
        *others,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, d -> d.start))").alias("first_word"),
        F.expr("array_max(transform(base, d -> d.start))").alias("last_word"),
        _labels("base").alias("base_labels"),
        _labels("detections").alias("labels"),
        F.expr(f"coalesce(array_max(transform(detections, d -> element_at(array({tiers}), d.tier + 1))), 0D)").alias("score"),
    )
