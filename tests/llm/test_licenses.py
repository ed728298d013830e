import re

from navlake.llm import licenses
from llm_odd import ODD


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base_by_hand(text):
    w, places = words(text), []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    labels = ",".join(sorted({label for _, label in places}))
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), labels


TEXTS = [
    "Released under the MIT License. Under-the (MIT) license, under the\nmit license",
    "Apache License, Version 2.0; APACHE LICENSE VERSION 2", "CC BY-NC 4.0", "cc by ncx under the mit licenses",
    "under the mit under the mit license", "É under the mit license É", "under the mit license " * 3000,
]


def test_base_places_of_odd_and_given_texts(docs_of, given):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(TEXTS)]]
    for frame, texts in ((docs_of(*rows), [r[:2] for r in rows]),
                         (given, [(r["doc_id"], r["text"]) for r in given.collect()])):
        got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])
                      for r in licenses.digest(licenses.scan_documents(frame)).collect()), key=str)
        assert got == sorted(((d, *base_by_hand(t)) for d, t in texts), key=str)


def test_labels_hold_the_base_and_scores_are_shares(docs_of):
    for r in licenses.digest(licenses.scan_documents(docs_of(*enumerate(TEXTS)))).collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and r["labels"].split(",") == sorted(set(r["labels"].split(",")))


def test_rules_are_many_and_gated():
    rules = licenses.rules()
    assert len(rules) > 200
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    assert licenses.detect(licenses.words_of("an ordinary text about nothing at all " * 50)) == []


def labels(text):
    return [d[2] for d in licenses.detect(licenses.words_of(text))]


def test_detections_and_overlaps():
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl-3"]
    assert labels("SPDX-License-Identifier: Apache-2.0") == ["apache-2"]
    assert labels("Licensed under the Apache License, Version 2.0 (the License)") == ["apache-2"]
    assert labels("Licensed under CC BY-NC-SA 4.0.") == ["cc-by-nc-sa"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc"]
    assert labels("GNU Lesser General Public License, version 2.1 license") == ["lgpl-2.1"]
    assert labels("the MIT license and the ISC license") == ["mit", "isc"]
    assert labels("distributed under the Mozilla Public License 2.0") == ["mpl-2"]
    first, past, label, confidence = licenses.detect(licenses.words_of("x y released under the MIT license z"))[0]
    assert (first, past, label) == (2, 7, "mit") and confidence > 0.9


def test_empty(empty):
    assert licenses.digest(licenses.scan_documents(empty)).collect() == []


def test_a_far_later_does_not_swallow_what_is_between():
    text = ("licensed under the MIT license or bundled parts " + "of it " * 400 + "released under the BSD 3 clause "
            "license and see the zlib license for details later")
    assert labels(text) == ["mit", "bsd-3", "zlib"]
    later = "distributed under the GPL version 2 or (at your option) any later version of it"
    assert [d[1] for d in licenses.detect(licenses.words_of(later))] == [13]


def spelled(tree):
    """Every text that a parsed expression of words, choices and optional parts matches."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            more = [chr(arg)]
        elif op == "IN":
            more = [chr(c) for kind, c in arg if str(kind) == "LITERAL"]
            assert len(more) == len(arg)
        elif op == "BRANCH":
            more = [t for branch in arg[1] for t in spelled(branch)]
        elif op == "SUBPATTERN":
            more = spelled(arg[-1])
        elif op == "MAX_REPEAT":
            assert arg[:2] == (0, 1)
            more = ["", *spelled(arg[2])]
        else:
            assert op in ("ASSERT", "ASSERT_NOT"), op
            continue
        out = [a + b for a in out for b in more]
    return out


def test_no_rule_misses_a_text_through_its_keywords():
    from re import _parser

    from navlake.llm.licenses import NAMES, WORDINGS

    for label, needs, name in NAMES:
        for text in spelled(_parser.parse(name)):
            assert set(text.split()) & set(needs.split("|")), (label, text)
    for wording, needs, *_ in WORDINGS:
        for text in spelled(_parser.parse(wording.format(name="name"))):
            assert set(text.split()) & set(needs.split("|")), (wording, text)
    assert labels("licensed under the FreeBSD license") == ["bsd-2"]
    assert labels("under the General Public License version 2 license") == ["gpl-2"]
    assert labels("licensed under the PNG Reference Library license") == ["libpng"]
    assert labels("see the creative commons attribution no derivs license") == ["cc-by-nd"]


def test_grant_texts_headers_and_names_without_version():
    gnu = "GNU {} Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    wanted = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy": "boost-1",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "isc",
        "Redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software": "bsd-3",
        "All advertising materials mentioning features or use of this software must display the following": "bsd-4",
        "The origin of this software must not be misrepresented;": "zlib",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        **{gnu.format("General", n): f"gpl-{n}" for n in (1, 2, 3)},
        gnu.format("Library General", 2): "lgpl-2", gnu.format("Lesser General", "2.1"): "lgpl-2.1",
        gnu.format("Lesser General", 3): "lgpl-3", gnu.format("Affero General", 3): "agpl-3",
        "under the terms of the GNU General Public License version 2 of the License": "gpl-2",
        "released under the GPL": "gpl", "licensed under the LGPL": "lgpl", "see the AGPL license": "agpl",
        "the Mozilla Public License": "mpl", "licensed under the Apache License": "apache",
        "a BSD-style license": "bsd", "License: EPL": "epl",
    }
    assert {t: labels(t) for t in wanted} == {t: [label] for t, label in wanted.items()}
    assert labels("licensed under the GPL version 3") == ["gpl-3"]


def test_suppression_against_all_pairs():
    import random

    rng = random.Random(8)
    kinds = [licenses.Rule(f"l{i}", (), re.compile("x"), p, 0.5) for i, p in enumerate((6, 5, 5, 2, 1, 0, 0))]
    for _ in range(300):
        found = []
        for _ in range(rng.randrange(1, 25)):
            start = rng.randrange(40)
            found.append((start, start + rng.randrange(1, 12), rng.choice(kinds)))
        stays = []
        for start, end, rule in sorted(found, key=lambda f: (-f[2].priority, f[0] - f[1], f[0], f[2].label)):
            if not any(a <= start and end <= b or start <= a and b <= end or not rule.priority and a < end and start < b
                       for a, b, _ in stays):
                stays.append((start, end, rule))
        assert licenses.suppressed(found) == sorted(stays, key=lambda f: f[:2])


def test_word_numbers_of_detections():
    text = "é released under the MIT license. x " * 50
    w = words(text)
    for first, past, label, _ in licenses.detect(licenses.words_of(text)):
        assert w[first:past] == ["released", "under", "the", "mit", "license"] and label == "mit"
    assert len(licenses.detect(licenses.words_of(text))) == 50


def test_time_follows_the_length():
    import time

    took = []
    for n in (4_000, 16_000):
        w = licenses.words_of("released under the MIT license and see the GPL license " * n)
        begin = time.time()
        assert len(licenses.detect(w)) == 2 * n and len(licenses.base_places(w)) == n
        took.append(time.time() - begin)
    assert took[1] < 10 * max(took[0], 0.1)


def test_license_texts_beyond_names():
    wanted = {
        "You may not use this file except in compliance with the License.": "apache-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
        "made available under the terms of the Eclipse Public License v1.0": "epl-1",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
        "https://creativecommons.org/publicdomain/zero/1.0/": "cc0-1",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "ofl-1.1",
        "You should have received a copy of the GNU General Public License": "gpl",
        "has been placed in the public domain by its author": "public-domain",
    }
    for text, label in wanted.items():
        assert label in labels(text), text
