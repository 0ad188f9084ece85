import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docsift.llm import licences as L
from docsift.llm.licence_names import identifiers, label_of, less_general
from docsift.llm.licence_names import notices as known_notices

SCAN = L.Scanner()


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), ",".join(sorted(labels))


PIECES = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "BY", "nc", "x", "É", ".", "\n", "-", "İ", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map(" ".join))
def test_places_equal_brute_force(text):
    found = SCAN(text)
    assert (found.n_words, found.places, ",".join(sorted(found.base_labels))) == brute(text)


def test_overlapping_and_touching_phrases():
    assert SCAN("cc by nc cc by nc").places == [0, 3]
    assert SCAN("(Under-the-MIT-License)").places == [0]
    assert SCAN("under the mit licenses").places == []


def test_query_equals_brute_force(spark, odd, odd_rows, documents, texts_of):
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows]), (documents, list(texts_of.items()))):
        got = sorted(
            (str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]), r["base_labels"])
            for r in L.scan_licences(df).collect()
        )
        want = []
        for doc_id, text in rows:
            n, places, labels = brute(text)
            ends = (places[0], places[-1]) if places else (None, None)
            want.append((str(doc_id), n, len(places), str(ends[0]), str(ends[1]), labels))
        assert got == sorted(want)


@pytest.mark.parametrize(
    ("expression", "postfix", "free"),
    [
        ("MIT", "mit", True),
        ("MIT OR GPL-3.0-only", "mit gpl-3.0-only or", True),
        ("MIT AND GPL-3.0-only", "mit gpl-3.0-only and", False),
        ("GPL-2.0 OR MIT AND Apache-2.0", "gpl-2.0 mit apache-2.0 and or", True),
        ("(GPL-2.0 OR MIT) AND GPL-3.0", "gpl-2.0 mit or gpl-3.0 and", False),
        ("Apache-2.0 WITH LLVM-exception OR GPL-2.0", "apache-2.0 llvm-exception with gpl-2.0 or", True),
        ("((MIT)) and zlib */", "mit zlib and", True),
        ("MIT or", "mit", True),
        ("MIT and (", "mit", True),
        ("(MIT OR zlib", "mit zlib or", True),
        ("MIT. See the file", "mit", True),
        ("OR MIT", "", False),
        ("", "", False),
        ("()", "", False),
        ("MIT) OR GPL", "mit", True),
    ],
)
def test_expressions(expression, postfix, free):
    assert " ".join(L.parse(expression)) == postfix
    assert L.evaluate(L.parse(expression), L.PERMISSIVE) is free


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["mit", "gpl", "and", "or", "with", "(", ")", "/", "x."]), max_size=12).map(" ".join))
def test_any_expression_evaluates(expression):
    postfix = L.parse(expression)
    L.evaluate(postfix, L.PERMISSIVE)
    assert bool(L.licences(postfix)) == bool(postfix)


def test_tags_add_labels_and_score():
    found = SCAN("// SPDX-License-Identifier: (MIT OR GPL-3.0-only) AND zlib\nAll rights reserved")
    assert found.labels == {"mit", "gpl-3.0-only", "zlib", "all-rights-reserved"}
    assert found.base_labels == set() and found.permissive is False
    assert found.score == pytest.approx(1 - 0.05 * 0.4)
    assert SCAN("spdx license identifier").score == 0 and SCAN("").permissive is None


@pytest.mark.parametrize(
    ("text", "labels", "free"),
    [
        ("licensed under the BSD 3-Clause License", {"bsd-3-clause"}, True),
        ("Licensed under CC0 1.0 Universal", {"cc0-1.0"}, True),
        ("GPLv3+", {"gpl-3.0"}, False),
        ("SPDX-License-Identifier: see LICENSE file", set(), None),
        ("SPDX-License-Identifier: TODO add license", set(), None),
        ("SPDX-License-Identifier: Apache-2.0\nApache License, Version 2.0", {"apache-2"}, True),
        ("GNU General Public License\nSPDX-License-Identifier: GPL-3.0", {"gpl-3.0-only"}, False),
        ("SPDX-License-Identifier: GPL-2.0+ OR MPL-1.1+", {"gpl-2.0-or-later", "mpl-1.1"}, False),
        ("SPDX-License-Identifier: LicenseRef-Own OR MIT", {"licenseref-own", "mit"}, True),
        ("SPDX-License-Identifier: DocumentRef-a:LicenseRef-b", {"documentref-a:licenseref-b"}, False),
        ("SPDX-License-Identifier: MIT and see the file", {"mit"}, False),
        ("GNU Lesser General Public License v2.1 or later", {"lgpl-2.1-or-later"}, False),
        ("LGPLv2.1", {"lgpl-2.1"}, False),
        ("Mozilla Public License Version 2.0", {"mpl-2.0"}, False),
        ("Creative Commons Attribution-ShareAlike 4.0 International", {"cc-by-sa-4.0"}, False),
        ("under CC BY-NC-SA 4.0", {"cc-by-nc", "cc-by-nc-sa-4.0"}, False),
        ("Under the MIT License.", {"mit"}, True),
        ("released into the public domain", {"public-domain"}, True),
        ("This is free and unencumbered software released into the public domain", {"unlicense"}, True),
    ],
)
def test_common_notices_have_one_label(text, labels, free):
    found = SCAN(text)
    assert (found.labels, found.permissive) == (labels, free)
    assert (found.score > 0) == bool(labels)


PHRASES = known_notices()


def outermost(text):
    """Labels of the notices that lie in no longer one, by looking for every phrase at every word."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    spans = {}
    for i in range(len(words)):
        for n in range(1, 31):
            phrase = " ".join(words[i : i + n])
            if i + n <= len(words) and (phrase in PHRASES or phrase in L.BASE):
                spans[i, i + n] = phrase
    inner = {s for s in spans for o in spans if o != s and o[0] <= s[0] and s[1] <= o[1]}
    base = {L.BASE[p] for p in spans.values() if p in L.BASE}
    return less_general({PHRASES[p] for s, p in spans.items() if s not in inner and p in PHRASES} | base, base)


MORE = ["gnu", "general", "public", "license", "gpl", "gplv3", "or", "later", "bsd", "3", "clause", "0", "v2", "new"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*MORE, "under", "the", "mit", "cc", "by", "nc", "sa", "4", *sorted(PHRASES)[::40]]), max_size=14))
def test_notices_equal_brute_force(pieces):
    text = " ".join(pieces)
    assert SCAN(text).labels == outermost(text)


def test_every_listed_identifier_has_a_label_and_keeps_it():
    listed = identifiers()
    for name in listed:
        assert SCAN(f"SPDX-License-Identifier: {name.upper()}").labels >= {label_of(name, listed)}
    assert {"mit", "apache-2.0", "gpl-3.0-or-later", "cc-by-sa-4.0", "bsd-3-clause"} <= listed
    assert label_of("mitt", listed) is None and label_of("", listed) is None
