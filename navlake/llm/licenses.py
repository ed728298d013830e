"""License scans by ordered signature rules.

A text becomes its words in lower case, one space apart. Rules are regular expressions over
that, made from the names of the licenses (hand-written) and the wordings they stand in. A rule
runs only where the words its license needs are present. Of detections of which one lies inside
another the rule of higher priority stays, the wider one among equals.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_V = r"(?: version| v)?"
_LIC = r" (?:public )?licen[cs]e"

# Label, the words that must all be present (alternatives joined by |), the name's expression.
NAMES = [
    ("mit", "mit", r"(?:the )?mit(?: x11)?"),
    ("mit-0", "mit", r"mit (?:no attribution|0)"),
    ("x11", "x11", r"(?:mit )?x11"),
    ("expat", "expat", r"expat"),
    ("apache-1", "apache", rf"apache(?: software)?(?: licen[cs]e)?{_V} 1(?: [01])?"),
    ("apache-2", "apache", rf"apache(?: software)?(?: licen[cs]e)?{_V} 2(?: 0)?"),
    ("bsd-0", "bsd|0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)"),
    ("bsd-2", "bsd|freebsd", r"(?:(?:bsd (?:2|two) clause)|(?:(?:2|two) clause bsd)|(?:simplified bsd)|freebsd)"),
    ("bsd-3", "bsd", r"(?:(?:bsd (?:3|three) clause)|(?:(?:3|three) clause bsd)|(?:(?:new|modified|revised) bsd))"),
    ("bsd-4", "bsd", r"(?:(?:bsd (?:4|four) clause)|(?:(?:4|four) clause bsd)|(?:(?:original|old) bsd))"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng|png", rf"(?:png reference library|libpng){_V}(?: 2)?"),
    ("boost-1", "boost|bsl", rf"(?:boost(?: software)?(?: licen[cs]e)?{_V} 1(?: 0)?|bsl 1 0)"),
    ("gpl-1", "general|gpl", rf"(?:gnu )?(?:gpl|general public(?: licen[cs]e)?){_V} 1(?: 0)?"),
    ("gpl-2", "general|gpl|gplv2", rf"(?:gnu )?(?:gplv2|(?:gpl|general public(?: licen[cs]e)?){_V} 2)(?: 0)?"),
    ("gpl-3", "general|gpl|gplv3", rf"(?:gnu )?(?:gplv3|(?:gpl|general public(?: licen[cs]e)?){_V} 3)(?: 0)?"),
    ("lgpl-2", "library|lgpl", rf"(?:gnu )?(?:lgpl|library general public(?: licen[cs]e)?){_V} 2(?: 0)?"),
    ("lgpl-2.1", "lesser|lgpl", rf"(?:gnu )?(?:lgpl|lesser general public(?: licen[cs]e)?){_V} 2 1"),
    ("lgpl-3", "lesser|lgpl|lgplv3", rf"(?:gnu )?(?:lgplv3|(?:lgpl|lesser general public(?: licen[cs]e)?){_V} 3)(?: 0)?"),
    ("agpl-3", "affero|agpl|agplv3", rf"(?:gnu )?(?:agplv3|(?:agpl|affero general public(?: licen[cs]e)?){_V} 3)(?: 0)?"),
    ("fdl-1", "documentation|gfdl", rf"(?:gnu )?(?:gfdl|free documentation(?: licen[cs]e)?){_V} 1(?: [123])?"),
    ("mpl-1", "mozilla|mpl", rf"(?:mpl|mozilla public(?: licen[cs]e)?){_V} 1(?: [01])?"),
    ("mpl-2", "mozilla|mpl", rf"(?:mpl|mozilla public(?: licen[cs]e)?){_V} 2(?: 0)?"),
    ("epl-1", "eclipse|epl", rf"(?:epl|eclipse public(?: licen[cs]e)?){_V} 1(?: 0)?"),
    ("epl-2", "eclipse|epl", rf"(?:epl|eclipse public(?: licen[cs]e)?){_V} 2(?: 0)?"),
    ("cddl-1", "cddl|distribution", rf"(?:cddl|common development and distribution(?: licen[cs]e)?){_V} 1(?: [01])?"),
    ("cpl-1", "cpl|common", rf"(?:cpl|common public(?: licen[cs]e)?){_V} 1(?: 0)?"),
    ("eupl-1", "eupl|european", rf"(?:eupl|european union public(?: licen[cs]e)?){_V} 1(?: [012])?"),
    ("artistic-1", "artistic", rf"artistic(?: licen[cs]e)?{_V} 1(?: 0)?"),
    ("artistic-2", "artistic", rf"artistic(?: licen[cs]e)?{_V} 2(?: 0)?"),
    ("ms-pl", "microsoft|ms", r"(?:microsoft public|ms pl)"),
    ("ms-rl", "microsoft|ms", r"(?:microsoft reciprocal|ms rl)"),
    ("ofl-1.1", "ofl|font", rf"(?:sil )?(?:ofl|open font(?: licen[cs]e)?){_V} 1 1"),
    ("psf-2", "python|psf", rf"(?:psf|python software foundation(?: licen[cs]e)?){_V} 2(?: 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl|fuck", r"(?:wtfpl|do what the fuck you want to(?: public)?)"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl(?: ssleay)?"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("cc0-1", "cc0", rf"(?:creative commons )?cc0{_V}(?: 1(?: 0)?)?(?: universal)?"),
    ("cc-by", "cc|attribution", rf"(?:cc by|creative commons attribution){_V}(?: [1234](?: 0)?)?"),
    ("cc-by-sa", "cc|sharealike|alike", rf"(?:cc by sa|creative commons attribution share ?alike){_V}(?: [1234](?: 0)?)?"),
    ("cc-by-nd", "cc|derivatives|noderivatives|noderivs|derivs", rf"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s){_V}(?: [1234](?: 0)?)?"),
    ("cc-by-nc", "cc|noncommercial|commercial", rf"(?:cc by nc|creative commons attribution non ?commercial){_V}(?: [1234](?: 0)?)?"),
    ("cc-by-nc-sa", "cc|sharealike|alike", rf"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike){_V}(?: [1234](?: 0)?)?"),
    ("cc-by-nc-nd", "cc|derivatives|noderivatives|noderivs|derivs", rf"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s){_V}(?: [1234](?: 0)?)?"),
    ("public-domain", "domain", r"public domain(?: dedication)?"),
]

# Wording around a name, its words (one must be present), priority, confidence.
WORDINGS = [
    (r"spdx licen[cs]e identifier {name}(?: only| or later)?", "spdx", 6, 1.0),
    (rf"(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms of )?(?:the )?{{name}}(?:{_LIC})?(?: or (?:at your option )?(?:any )?later(?: version)?)?", "under", 5, 0.97),
    (rf"(?:subject to|governed by|covered by|in accordance with|according to) (?:the )?(?:terms of )?(?:the )?{{name}}(?:{_LIC})?", "to|by|with", 4, 0.9),
    (rf"(?:see|read|copy of) (?:the )?{{name}}{_LIC}", "see|read|copy", 3, 0.85),
    (rf"{{name}}{_LIC}", "license|licence", 2, 0.8),
    (r"licen[cs]e (?:is )?(?:the )?{name}", "license|licence", 1, 0.7),
]

# Names without a version: label, words, expression. They stand behind all rules above.
UNVERSIONED = [
    ("gpl", "general|gpl", r"(?:gnu )?(?:gpl|general public)"),
    ("lgpl", "lesser|library|lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public)"),
    ("agpl", "affero|agpl", r"(?:gnu )?(?:agpl|affero general public)"),
    ("mpl", "mozilla|mpl", r"(?:mpl|mozilla public)"),
    ("apache", "apache", r"apache(?: software)?"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("epl", "eclipse|epl", r"(?:epl|eclipse public)"),
]

_EITHER = r"(?: as published by the free software foundation)?(?: either)? version"
_OF_LATER = r"(?: of the licen[cs]e)?(?: or (?:at your option )?(?:any )?later(?: version)?)?"

# What licensed files carry besides a name: label, words, expression, priority, confidence.
TEXTS = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 7, 0.95),
    ("boost-1", "hereby", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 7, 0.95),
    ("isc", "fee", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", 7, 0.95),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 7, 0.9),
    ("bsd-3", "neither", r"neither the names? of(?: \S+){1,20} may be used to endorse or promote products derived from this software", 7, 0.95),
    ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display", 7, 0.95),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented", 7, 0.95),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 7, 0.95),
    ("mit", "substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 7, 0.9),
    ("apache-2", "compliance", r"you may not use this (?:file|software|work) except in compliance with the licen[cs]e", 7, 0.8),
    ("apache-2", "unless", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", 7, 0.9),
    ("apache-2", "apache", r"www apache org licen[cs]es licen[cs]e 2 0", 7, 0.95),
    ("apache-1", "apache", r"this product includes software developed by the apache (?:group|software foundation)", 7, 0.9),
    ("mpl-1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1(?: [01])?", 7, 0.95),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0", 7, 0.95),
    ("epl-1", "eclipse", r"made available under the terms of the eclipse public licen[cs]e v ?1 0", 7, 0.95),
    ("epl-2", "eclipse", r"made available under the terms of the eclipse public licen[cs]e v ?2 0", 7, 0.95),
    ("cddl-1", "distribution", r"the terms of the common development and distribution licen[cs]e", 7, 0.9),
    ("cpl-1", "common", r"made available under the terms of the common public licen[cs]e v ?1 0", 7, 0.95),
    ("eupl-1", "eupl", r"licen[cs]ed under the eupl version 1(?: [012])?", 7, 0.95),
    ("agpl-3", "affero", r"www gnu org licen[cs]es agpl", 7, 0.8),
    ("gpl", "gnu", r"you should have received a copy of the gnu general public licen[cs]e", 6.5, 0.8),
    ("lgpl", "gnu", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", 6.5, 0.8),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public licen[cs]e", 6.5, 0.8),
    ("gpl", "redistribute", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 0.4, 0.9),
    ("lgpl", "redistribute", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", 0.4, 0.9),
    ("fdl-1", "invariant", r"with no invariant sections no front cover texts and no back cover texts", 7, 0.95),
    ("ofl-1.1", "font", r"this font software is licen[cs]ed under the sil open font licen[cs]e version 1 1", 7, 0.97),
    ("ofl-1.1", "reserved", r"reserved font name", 6.5, 0.7),
    ("artistic-2", "artistic", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document but changing it is not allowed", 6.5, 0.6),
    ("wtfpl", "want", r"you just do what the fuck you want to", 7, 0.95),
    ("cc0-1", "waived", r"has waived all copyright and related or neighboring rights", 7, 0.9),
    ("cc0-1", "publicdomain", r"creativecommons org publicdomain zero 1 0", 7, 0.95),
    ("public-domain", "domain", r"(?:placed|dedicated|released) (?:in|into|to) the public domain", 6.5, 0.85),
    ("psf-2", "python", r"the python software foundation psf is making python available to licensee on an as is basis", 7, 0.9),
    ("postgresql", "agreement", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 7, 0.95),
    ("openssl", "openssl", r"this product includes software developed by the openssl project", 7, 0.9),
    ("ncsa", "names", r"neither the names of(?: \S+){1,20} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", 6.5, 0.7),
    ("libpng", "png", r"the contributing authors and group 42 inc disclaim all warranties", 7, 0.9),
    ("x11", "consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising", 7, 0.95),
    ("bsd-2", "merchantability", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties", 6.5, 0.6),
    ("ms-pl", "reciprocal|contributor", r"each contributor grants you a non exclusive worldwide royalty free copyright licen[cs]e", 6.5, 0.6),
    *[(f"cc-{kind}", "creativecommons", rf"creativecommons org licen[cs]es {kind.replace('-', ' ')} [1234] [05]", 6.6, 0.95)
      for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")],
    *[(f"gpl-{n}", "general", rf"(?:gnu )?general public licen[cs]e{_EITHER} {n}(?: 0)?{_OF_LATER}", 0.5, 0.95) for n in (1, 2, 3)],
    ("lgpl-2", "library|lesser", rf"(?:gnu )?(?:library|lesser) general public licen[cs]e{_EITHER} 2(?: 0)?(?! 1 ){_OF_LATER}", 0.5, 0.95),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{_EITHER} 2 1{_OF_LATER}", 0.5, 0.95),
    ("lgpl-3", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{_EITHER} 3(?: 0)?{_OF_LATER}", 0.5, 0.95),
    ("agpl-3", "affero", rf"(?:gnu )?affero general public licen[cs]e{_EITHER} 3(?: 0)?{_OF_LATER}", 0.5, 0.95),
]

_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


@dataclass(frozen=True)
class Rule:
    label: str
    needs: tuple[frozenset, ...]
    pattern: re.Pattern
    priority: int
    confidence: float


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """Every name in every wording and the texts, by falling priority; all expressions match whole words."""
    made = []
    for wording, words, priority, confidence in WORDINGS:
        for label, keywords, name in NAMES:
            made.append(Rule(
                label, (frozenset(keywords.split("|")), frozenset(words.split("|"))),
                re.compile(rf"(?<= ){wording.format(name=f'(?:{name})')}(?= )"), priority, confidence))
        for label, keywords, name in UNVERSIONED:
            made.append(Rule(
                label, (frozenset(keywords.split("|")), frozenset(words.split("|"))),
                re.compile(rf"(?<= ){wording.format(name=f'(?:{name})')}(?= )"), 0, min(confidence, 0.8)))
    for label, keywords, text, priority, confidence in TEXTS:
        made.append(Rule(label, (frozenset(keywords.split("|")),), re.compile(rf"(?<= ){text}(?= )"), priority, confidence))
    return tuple(sorted(made, key=lambda r: -r.priority))


@lru_cache(maxsize=1)
def keywords() -> frozenset:
    return frozenset().union(*(r.needs[0] for r in rules()))


def words_of(text: str | None) -> list[bytes]:
    r"""The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class _Stays:
    """Spans of which none lies inside another: in the order of their starts their ends rise too."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int, only_whole: bool) -> bool:
        """Whether the span lies inside one, or holds one, or (unless ``only_whole``) overlaps one."""
        before, after = bisect_right(self.starts, start) - 1, bisect_left(self.starts, start)
        if before >= 0 and (self.ends[before] >= end or not only_whole and self.ends[before] > start):
            return True
        return after < len(self.starts) and (
            self.ends[after] <= end or not only_whole and self.starts[after] < end)

    def add(self, start: int, end: int) -> None:
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """The detections that stay, in order.

    By falling priority, wider first: what lies inside an earlier one, or holds it, goes. A name
    without a version (priority 0) goes where it only meets another.
    """
    stays, out = _Stays(), []
    for start, end, rule in sorted(found, key=lambda f: (-f[2].priority, f[0] - f[1], f[0], f[2].label)):
        if not stays.meets(start, end, bool(rule.priority)):
            stays.add(start, end)
            out.append((start, end, rule))
    return sorted(out, key=lambda f: f[:2])


def _spaces_before(joined, space, places: list[int]) -> dict[int, int]:
    """How many spaces stand before each place, counted once along the text."""
    counts, last, total = {}, 0, 0
    for at in sorted(places):
        total += joined.count(space, last, at)
        counts[at], last = total, at
    return counts


def detect(words: list[bytes]) -> list[tuple[int, int, str, float]]:
    """``(first word, one past the last word, label, confidence)`` of what stays, in order."""
    present = {w.decode("utf-8", "surrogatepass") for w in set(words)}
    if not present & keywords():
        return []
    joined = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    stays = suppressed([
        (m.start(), m.end(), rule)
        for rule in rules() if all(present & need for need in rule.needs)
        for m in rule.pattern.finditer(joined)
    ])
    at = _spaces_before(joined, " ", [x for start, end, _ in stays for x in (start, end)])
    return [(at[start] - 1, at[end], rule.label, rule.confidence) for start, end, rule in stays]


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """``(first word, label)`` of every place where a base phrase's words stand in a row."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in BASE.items():
        seek = b" " + phrase.encode() + b" "
        at = joined.find(seek)
        while at >= 0:
            found.append((at, label))
            at = joined.find(seek, at + 1)
    before = _spaces_before(joined, b" ", [at for at, _ in found])
    return sorted((before[at], label) for at, label in found)


SCANNED = (
    "n_words long, base array<struct<word: long, label: string>>, "
    "detected array<struct<first: long, past: long, label: string, confidence: double>>")


def scan(text: Column) -> Column:
    """A struct of the words counted, the base places and the detections of a text."""

    @F.pandas_udf(SCANNED)
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                words = words_of(t)
                rows.append((
                    len(words),
                    [{"word": w, "label": label} for w, label in base_places(words)],
                    [{"first": a, "past": b, "label": label, "confidence": c} for a, b, label, c in detect(words)],
                ))
            yield pd.DataFrame(rows, columns=["n_words", "base", "detected"])

    return of_batches(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with ``licenses``, the struct that ``scan`` gives.

    A null or empty text has no words and no places. Repeated rows are scanned alike, an empty
    table gives no rows, and an input column of that name is replaced.
    """
    return docs.drop("licenses").withColumn("licenses", scan(F.col("text")))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and labels per document; ``score`` is the best confidence, 1 for a base place."""
    base = F.col("licenses.base")
    labels = F.array_sort(F.array_distinct(base["label"]))
    every = F.array_sort(F.array_union(base["label"], F.col("licenses.detected.label")))
    best = F.coalesce(F.array_max(F.col("licenses.detected.confidence")), F.lit(0.0))
    return scanned.select(
        "doc_id", F.col("licenses.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"), F.array_max(base["word"]).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
