from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hackney.llm import licenses
from hackney.llm.sql import _pattern
from tests.llm.helpers import ODD, documents, prose


def plain(text):
    """(words, phrases as (first, after, label))."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = []
    for phrase, label in licenses.PHRASES.items():
        wanted = phrase.split()
        found += [(i, i + len(wanted), label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return words, sorted(found)


def plain_labels(words):
    line = " " + "".join(f"{w} " for w in words)
    return {label for label, t in licenses.TEMPLATES.items() if re.search(_pattern(t), line)}


NOTICES = [
    "This work is licensed under the GNU General Public License, version 3.",
    "This is a free software licensed under the terms of the GNU General Public License version 3",
    "This program is free software and is licensed under the terms of the GNU GENERAL public-license, version 3 or any later version",
    "GNU General Public\nLicense gnu general public license",
    "Licensed under CC BY-NC 4.0.", "licensed under a cc-by 4 0 international license", "cc by cc by",
    "Released under the MIT License.", "Released under the terms of the M.I.T. License", "mit, license mit license",
    "Licensed under the Apache License, Version 2.0.", "apache  LICENSE", "Apache éLicense", "xmit license",
    licenses.TEMPLATES["mit-text"].replace("<<beginOptional>>", "").replace("<<endOptional>>", ""),
    re.sub("<<.*?>>", "", licenses.TEMPLATES["mit-text"]).replace("free of charge", "free for a charge"),
    re.sub("<<b.*?>>|<<e.*?>>", "", licenses.TEMPLATES["apache-2.0-notice"]).replace('<<var;name="address";match=".{1,12}">>', "http://a.b/c"),
]


def rows():
    rng = random.Random(6)
    made = []
    for n in range(200):
        parts = [prose(n, 10)] + rng.sample(NOTICES, rng.randrange(4)) + [prose(n + 500, 10)]
        made.append((n, rng.choice([" ", "\n", ". "]).join(parts)))
    return made + ODD + [(300, " ".join(NOTICES) * 100)]


def test_labels_places_and_spans(spark):
    found = licenses.scan_licenses(documents(spark, rows())).collect()
    assert len(found) == len(rows())
    got = sorted(
        (repr(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in found
    )
    want, all_labels = [], set()
    for i, text in rows():
        words, base = plain(text)
        names, own = {label for *_, label in base}, plain_labels(words)
        starts = [a for a, *_ in base]
        score = 1.0 if own else 0.5 if base else 0.0
        want.append((
            repr(i), len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(names)), ",".join(sorted(names | own)), score,
        ))
        all_labels |= own
        for r in found:
            if r.doc_id == i and r.n_words == len(words):
                assert [(s.first, s.after, s.label) for s in r.spans if s.label in names] == base
    key = lambda row: repr(row)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {"gpl-3.0-notice", "mit-text", "mit-notice", "apache-2.0-notice", "cc-by-4.0-notice", "cc-by-nc-4.0-notice"} <= all_labels


TEMPLATE = """a <<beginOptional>>b <<beginOptional>>c<<endOptional>> <<var;name="x";match=".{0,2}">><<endOptional>> d
    <<var;name="y";match=".{1,2}">> e<<beginOptional>> a<<endOptional>>"""


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=12))
def test_automaton_agrees_with_an_expression(words):
    made = licenses.compile_template(TEMPLATE)
    raw = [w.encode() for w in words]
    line = " " + "".join(f"{w} " for w in words)
    hits = {i for i in range(len(words)) if made.end(raw, i) is not None}
    assert hits == {m.start() // 2 for m in re.finditer(f"(?={_pattern(TEMPLATE)})", line)}
    if hits:
        assert all(line.encode().find(run) >= 0 for run in licenses._mandatory(made))


def test_optional_regions_must_end():
    with pytest.raises(ValueError, match="does not end"):
        licenses.compile_template("a <<beginOptional>> b")


def as_written(label):
    """A license as its owners write it: every optional region there, and a name in every var region."""
    text = licenses.TEMPLATES[label].replace("<<beginOptional>>http<<endOptional>>", "")
    return " ".join(re.sub("<<var.*?>>", "Ann B. and others", re.sub("<<(begin|end)Optional>>", "", text)).split())


WHOLE = {
    "mit-text": "Permission is hereby granted", "isc-text": "Permission to use, copy", "apache-2.0-text": "TERMS AND CONDITIONS",
    "bsd-2-clause-text": "Redistribution and use", "bsd-3-clause-text": "Redistribution and use",
    "gpl-3.0-or-later-notice": "This Ann", "gpl-3.0-only-notice": "This Ann",
}


@pytest.mark.parametrize("label", WHOLE)
def test_every_mandatory_sentence_counts(label):
    scanner, text = licenses.Scanner({}, licenses.TEMPLATES), as_written(label)
    labels = lambda t: {name for *_, name in scanner.scan(f"before it {t} after it".encode())[2]}
    assert text.startswith(WHOLE[label]) and labels(text) == {label}
    # Parts of some words, without what is optional at the end.
    text = re.split(" If not, see| END OF TERMS", text)[0]
    ends = [m.end() for m in re.finditer(r"[.;:,] ", text) if not re.search(r"\b(\d|B|v)\. $", text[: m.end()])]
    parts = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]
    for n, part in enumerate(parts[:-1]):
        if len(part.split()) > 2 and "(including the next" not in part:
            assert label not in labels("".join(parts[:n] + parts[n + 1 :]))
            assert label not in labels("".join(parts[: n + 1]) + "It shall be used for Good, not Evil. " + "".join(parts[n + 1 :]))


GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>."""


def test_whole_texts_and_what_resembles_them(spark):
    mit = as_written("mit-text")
    near = [
        mit[: mit.index("THE SOFTWARE IS")],
        mit.replace("THE SOFTWARE IS", "The Software shall be used for Good, not Evil. THE SOFTWARE IS"),
        mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "X CONSORTIUM") + " Except as contained in this notice, the name of the X",
        as_written("isc-text").split(" THE SOFTWARE")[0],
    ]
    texts = [GPL, *map(as_written, WHOLE), *near]
    found = {r.doc_id: r for r in licenses.scan_licenses(documents(spark, list(enumerate(texts)))).collect()}
    wanted = ["gpl-3.0-or-later-notice", *WHOLE]
    for n, text in enumerate(texts):
        want = {wanted[n]} if n < len(wanted) else set()
        assert plain_labels(plain(text)[0]) == want
        assert set(found[n].labels.split(",")) - set(licenses.PHRASES.values()) == (want or {""})
        assert found[n].score == (1.0 if want else 0.0)


def test_no_documents(spark):
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_a_text_full_of_matches_takes_linear_time():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    started = time.monotonic()
    n, base, _ = scanner.scan(b"mit license " * 850_000)
    assert n == 1_700_000 and [a for a, _, _ in base] == list(range(0, n, 2))
    assert time.monotonic() - started < 20
