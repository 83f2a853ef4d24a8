"""License scans: ordered signature rules behind a keyword gate.

A text becomes its lower-cased words joined by single blanks. Base phrases are searched as they are.
Signature rules are regular expressions over the joined words; a rule runs only on texts that hold
its keyword, which one Aho-Corasick pass over the text decides for all rules. Detections of rules
overlap: in order of priority (then length, then place) a detection is dropped when an accepted one
contains it. Base detections are never dropped.

Defined cases: NULL and empty texts have no words and no detection; places count every occurrence,
overlapping ones included; repeated rows are scanned one by one; rules see whole texts however long.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arenalake.llm.common import docs_of
from arenalake.llm.words import column, small_batches, texts

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str  # a word or phrase every match holds
    pattern: str  # over lower-case words joined by single blanks
    priority: int  # lower is stronger
    score: float


# Families whose members differ by version only: label stem, name pattern, keyword, versions.
_VERSIONED = [
    ("gpl", r"gnu general public license", "general public license", ("1", "2", "3")),
    ("lgpl", r"gnu (?:lesser|library) general public license", "general public license", ("2", "2 1", "3")),
    ("agpl", r"(?:gnu )?affero general public license", "affero", ("1", "3")),
    ("gfdl", r"gnu free documentation license", "free documentation license", ("1 1", "1 2", "1 3")),
    ("mpl", r"mozilla public license", "mozilla", ("1 0", "1 1", "2 0")),
    ("epl", r"eclipse public license", "eclipse", ("1 0", "2 0")),
    ("cpl", r"common public license", "common public", ("0 5", "1 0")),
    ("apache", r"apache (?:software )?license", "apache", ("1 0", "1 1", "2 0")),
    ("cddl", r"common development and distribution license", "distribution license", ("1 0", "1 1")),
    ("eupl", r"european union public licen[cs]e", "european union", ("1 0", "1 1", "1 2")),
    ("artistic", r"artistic license", "artistic", ("1 0", "2 0")),
    ("osl", r"open software license", "open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", r"academic free license", "academic free", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("lppl", r"latex project public license", "latex", ("1 0", "1 2", "1 3")),
    ("zpl", r"zope public license", "zope", ("1 1", "2 0", "2 1")),
    ("php", r"php license", "php", ("3 0", "3 01")),
    ("ofl", r"(?:sil )?open font license", "open font", ("1 0", "1 1")),
    ("odbl", r"open database license", "open database", ("1 0",)),
    ("bsl", r"boost software license", "boost", ("1 0",)),
    ("busl", r"business source license", "business source", ("1 0", "1 1")),
    ("sspl", r"server side public license", "server side", ("1",)),
    ("elastic", r"elastic license", "elastic", ("1", "2", "2 0")),
    ("cecill", r"cecill", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("nposl", r"non profit open software license", "non profit open", ("3 0",)),
    ("apsl", r"apple public source license", "apple public", ("1 0", "1 1", "1 2", "2 0")),
    ("ms-pl", r"microsoft public license", "microsoft public", ("1",)),
    ("upl", r"universal permissive license", "universal permissive", ("1 0",)),
    ("ecl", r"educational community license", "educational community", ("1 0", "2 0")),
    ("openldap", r"openldap public license", "openldap", ("2 0 1", "2 8")),
    ("ibm-pl", r"ibm public license", "ibm public", ("1 0",)),
]

# Creative Commons: element words and their label.
_COMMONS = {
    "attribution": "by",
    "attribution sharealike": "by-sa", "attribution share alike": "by-sa",
    "attribution noncommercial": "by-nc", "attribution non commercial": "by-nc",
    "attribution noderivatives": "by-nd", "attribution noderivs": "by-nd", "attribution no derivatives": "by-nd",
    "attribution noncommercial sharealike": "by-nc-sa", "attribution non commercial share alike": "by-nc-sa",
    "attribution noncommercial noderivatives": "by-nc-nd", "attribution noncommercial noderivs": "by-nc-nd",
    "attribution non commercial no derivatives": "by-nc-nd",
}
_COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Short identifiers as they stand in headers, after the words' punctuation became blanks.
_IDENTIFIERS = (
    "mit", "isc", "zlib", "unlicense", "wtfpl", "bsd 2 clause", "bsd 3 clause", "0bsd", "apache 2 0", "apache 1 1",
    "gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later", "lgpl 2 1",
    "lgpl 2 1 only", "lgpl 2 1 or later", "lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later", "agpl 3 0", "agpl 3 0 only",
    "agpl 3 0 or later", "mpl 2 0", "mpl 1 1", "epl 1 0", "epl 2 0", "cc0 1 0", "cc by 4 0", "cc by sa 4 0",
    "cc by nc 4 0", "cc by nc sa 4 0", "cc by nd 4 0", "cc by nc nd 4 0", "bsl 1 0", "artistic 2 0", "postgresql",
    "python 2 0", "ncsa", "x11", "hpnd", "ofl 1 1", "odbl 1 0", "cddl 1 0", "upl 1 0", "blueoak 1 0 0",
)

# Sentences of license texts and notices: label, keyword, pattern, priority, score.
_SENTENCES = [
    ("mit", "mit license", r"(?:the )?mit license", 30, 0.9),
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 10, 1.0),
    ("mit", "mit license", r"(?:released|licensed|available|distributed|provided) under (?:the )?(?:terms of the )?mit license", 20, 0.95),
    ("expat", "expat", r"expat license", 30, 0.9),
    ("x11", "x11 license", r"x11 license", 30, 0.9),
    ("isc", "permission to use copy modify", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 10, 1.0),
    ("isc", "isc license", r"(?:the )?isc license", 30, 0.9),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted", 15, 0.95),
    ("bsd-3-clause", "neither the name", r"neither the name of .{1,120}? nor the names of (?:its|their) contributors may be used", 10, 1.0),
    ("bsd-3-clause", "bsd license", r"(?:3|three) clause bsd license", 12, 0.95),
    ("bsd-2-clause", "bsd license", r"(?:2|two) clause bsd license", 12, 0.95),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display", 10, 1.0),
    ("bsd", "bsd license", r"(?:(?:new|modified|simplified|revised) )?bsd license", 30, 0.8),
    ("bsd", "bsd style", r"bsd style licen[cs]e", 31, 0.7),
    ("zlib", "provided as is without any express", r"this software is provided as is without any express or implied warranty", 25, 0.7),
    ("zlib", "zlib", r"zlib(?: libpng)? license", 30, 0.9),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain", 10, 1.0),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain", 30, 0.8),
    ("public-domain", "public domain", r"(?:is|are) in the public domain", 35, 0.7),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 30, 0.85),
    ("cc0", "no rights reserved", r"no rights reserved", 40, 0.5),
    ("wtfpl", "what the fuck", r"do what the fuck you want to public license", 10, 1.0),
    ("gpl-2-or-later", "or at your option", r"gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", 5, 1.0),
    ("gpl-3-or-later", "or at your option", r"gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", 5, 1.0),
    ("lgpl-2-1-or-later", "or at your option", r"gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version", 5, 1.0),
    ("agpl-3-or-later", "or at your option", r"gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", 5, 1.0),
    ("gpl", "general public license", r"gnu general public license", 40, 0.8),
    ("gpl", "gpl", r"(?:licensed|released|distributed) under (?:the )?(?:gnu )?gpl", 35, 0.8),
    ("gpl-2", "gpl", r"(?:gnu )?gpl ?v ?2", 30, 0.85),
    ("gpl-3", "gpl", r"(?:gnu )?gpl ?v ?3", 30, 0.85),
    ("lgpl", "general public license", r"gnu (?:lesser|library) general public license", 39, 0.8),
    ("lgpl", "lgpl", r"(?:licensed|released|distributed) under (?:the )?(?:gnu )?lgpl", 35, 0.8),
    ("agpl", "affero", r"affero general public license", 38, 0.8),
    ("apache-2", "apache license version 2", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", 5, 1.0),
    ("apache-2", "apache", r"apache 2(?: 0)? license", 30, 0.9),
    ("apache", "apache license", r"(?:the )?apache license", 45, 0.7),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", 5, 1.0),
    ("ofl", "open font license", r"this font software is licensed under the sil open font license", 10, 1.0),
    ("python", "python software foundation", r"python software foundation license(?: version 2)?", 25, 0.9),
    ("ruby", "ruby", r"(?:same terms as|under the) ruby(?: license)?", 40, 0.7),
    ("perl", "perl itself", r"under the same terms as perl itself", 20, 0.9),
    ("vim", "vim license", r"vim license", 30, 0.9),
    ("beerware", "beer ware", r"the beer ware license", 20, 0.95),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", 30, 0.9),
    ("openssl", "openssl license", r"openssl license", 30, 0.9),
    ("json", "good not evil", r"the software shall be used for good not evil", 10, 1.0),
    ("cc-by-nc", "cc by nc", r"cc by nc", 33, 0.9),
    ("cc-by-sa", "cc by sa", r"cc by sa", 32, 0.9),
    ("cc-by-nd", "cc by nd", r"cc by nd", 32, 0.9),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", 31, 0.95),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", 31, 0.95),
    ("cc-by", "cc by", r"cc by", 36, 0.8),
    ("cc", "creative commons", r"creative commons(?: public)? licen[cs]e", 45, 0.6),
    ("proprietary", "all rights reserved", r"all rights reserved", 60, 0.3),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)", 50, 0.6),
    ("proprietary", "may not be reproduced", r"may not be reproduced (?:or distributed )?without (?:the )?(?:prior )?(?:express )?written (?:permission|consent)", 50, 0.6),
    ("non-commercial", "non commercial", r"(?:for )?non commercial (?:use|purposes) only", 50, 0.6),
    ("copyleft", "copyleft", r"copyleft licen[cs]e", 55, 0.4),
    ("permissive", "permissive", r"permissive licen[cs]e", 55, 0.4),
    ("eula", "end user licen", r"end user licen[cs]e agreement", 50, 0.6),
    ("dual", "dual licensed", r"dual licensed under", 50, 0.5),
]


def rules() -> tuple[Rule, ...]:
    """All signature rules in order of priority: the sentences above and the families spelled out."""
    found = [Rule(*x) for x in _SENTENCES]
    for stem, name, keyword, versions in _VERSIONED:
        for version in versions:
            label = f"{stem}-{version.removesuffix(' 0').replace(' ', '-')}"
            v = rf"(?: ?v)? ?{version}" if version.endswith(" 0") else rf"(?: ?v)? ?{version}(?! \d)"
            found += [
                Rule(label, keyword, rf"{name}(?: version| v)? {version.removesuffix(' 0')}(?: 0)?", 20, 0.95),
                Rule(label, keyword, rf"under the terms of the {name} version {version.removesuffix(' 0')}(?: 0)?", 15, 1.0),
                Rule(label, keyword, rf"{name} {v}", 25, 0.85),
            ]
        found.append(Rule(stem, keyword, name, 42, 0.7))
    for words, label in _COMMONS.items():
        found.append(Rule(f"cc-{label}", "creative commons", rf"creative commons {words}(?: (?:international|unported))?", 30, 0.85))
        for version in _COMMONS_VERSIONS:
            found.append(
                Rule(f"cc-{label}-{version.replace(' ', '-')}", "creative commons",
                     rf"creative commons {words} {version}(?: (?:international|unported))?(?: licen[cs]e)?", 18, 0.95)
            )
    for name in _IDENTIFIERS:
        found.append(Rule(name.replace(" ", "-"), f"spdx license identifier {name}", rf"spdx license identifier {name}", 8, 1.0))
    return tuple(sorted(found, key=lambda r: (r.priority, r.label, r.pattern)))


# Lower-cases A-Z and blanks everything below 0x80 that is no digit or letter: what is left are words.
_TO_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


class Scanner:
    """The gate and the compiled rules."""

    def __init__(self):
        import ahocorasick

        self.rules = rules()
        self.compiled: dict[int, re.Pattern] = {}
        by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            by_keyword.setdefault(rule.keyword, []).append(i)
        self.gate = ahocorasick.Automaton()
        for keyword, which in by_keyword.items():
            self.gate.add_word(keyword, which)
        self.gate.make_automaton()

    def candidates(self, text: str) -> list[int]:
        met: set[int] = set()
        for _, which in self.gate.iter(text):
            met.update(which)
        return sorted(met)

    def detections(self, text: str) -> list[tuple[int, int, Rule]]:
        """Accepted (start, end, rule) in characters of the joined words, strongest first."""
        hits = []
        for i in self.candidates(text):
            rule = self.rules[i]
            if i not in self.compiled:
                self.compiled[i] = re.compile(rf"(?<![^ ])(?:{rule.pattern})(?![^ ])")
            hits += [(m.start(), m.end(), rule) for m in self.compiled[i].finditer(text)]
        hits.sort(key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].label))
        accepted, cover = [], _Cover()
        for start, end, rule in hits:
            if not cover.contains(start, end):
                cover.add(start, end)
                accepted.append((start, end, rule))
        return accepted


class _Cover:
    """Accepted intervals none of which contains another, in order of both ends."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def contains(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end

    def add(self, start: int, end: int) -> None:
        # Intervals inside the new one can't contain anything it doesn't.
        first = at = bisect_right(self.starts, start - 1)
        while at < len(self.ends) and self.ends[at] <= end:
            at += 1
        self.starts[first:at], self.ends[first:at] = [start], [end]


def _places(text: str, phrase: str) -> Iterator[int]:
    """Starts of a phrase in ` word word ... ` with a blank at both ends."""
    at = text.find(f" {phrase} ")
    while at >= 0:
        yield at
        at = text.find(f" {phrase} ", at + 1)


def scan(scanner: Scanner, raw: bytes | None) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, labels, score, detections of one text."""
    words = (raw or b"").translate(_TO_WORDS).split(b" ")
    words = [w for w in words if w]
    joined = (b" ".join(words)).decode("utf-8", "replace")
    framed = f" {joined} "
    found = [(at, phrase) for phrase in BASE_PHRASES for at in _places(framed, phrase)]
    hits = scanner.detections(joined)
    base = {BASE_PHRASES[phrase] for _, phrase in found}
    labels = base | {rule.label for _, _, rule in hits}
    score = max([rule.score for _, _, rule in hits] + [1.0] * bool(base), default=0.0)
    first = last = None
    spots = []
    if found or hits:
        blanks = np.flatnonzero(np.frombuffer(framed.encode("utf-32-le"), np.uint32) == 32)
        word_at = lambda char: int(np.searchsorted(blanks, char, "right")) - 1
        spots = [(word_at(start), word_at(end), rule.label) for start, end, rule in hits]
    if found:
        first, last = word_at(min(found)[0]), word_at(max(found)[0])
    return len(words), len(found), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spots


_OUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, detections array<struct<first:long,last:long,label:string>>"
)


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    spot = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string())])
    for batch in batches:
        rows = [scan(scanner, text) for text in texts(batch)]
        arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        spots = [[{"first": a, "last": b, "label": c} for a, b, c in row[7]] for row in rows]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), *arrays, pa.array(spots, pa.list_(spot))], names=["doc_id", *names, "detections"]
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document; a scan needs no shuffle, so rows stay where they are read."""
    small_batches(docs.sparkSession)
    return docs_of(docs).mapInArrow(_scan_rows, _OUT)
