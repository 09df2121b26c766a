from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hackney.llm import spelling
from tests.llm.helpers import ODD, documents


def counts(rows):
    out = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def apart(a, b):
    """Whether two words are one letter apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = counts(rows)
    near = {w: [v for v in n if apart(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], form[w] and n[form[w]], root))
    return Counter(out)


def check(spark, rows, **options):
    found = spelling.variants(documents(spark, rows), **options).collect()
    assert Counter((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found) == plain(rows)


def texts(seed, letters, many, documents_=60, size=(3, 9)):
    rng = random.Random(seed)
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(*size))) for _ in range(many)]
    rows = []
    for i in range(documents_):
        out = []
        for _ in range(400):
            w = base[int(rng.random() ** 2 * many)]
            if rng.random() < 0.15:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "1"]).join(out)))
    return rows


def test_variants(spark):
    check(spark, texts(1, "abcdéÿ", 150) + ODD + [(None, "Étéàüx " * 5)] * 2)


def test_shards_that_are_halved(spark):
    rows = texts(2, "ab", 120, size=(4, 12)) + texts(3, "xyzç", 300, 20, (6, 9))
    check(spark, rows, shard=4)
    words = spelling.vocabulary(documents(spark, rows))
    dealt = spelling.shards(words, 4)
    sizes = dealt.groupBy(*spelling.KEY).count().collect()
    # What is left above the bound has one letter free.
    assert all(r["count"] <= 4 or r.m - r["first"] - r["last"] < 2 for r in sizes)
    assert len({r["first"] + r["last"] for r in sizes}) > 5


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=150, unique=True), st.integers(0, 12), st.integers(1, 4))
def test_recurrences(words, before, many):
    # A shard is of words of some length, and those that are one longer.
    m = len(words[0])
    words = sorted(w for w in words if len(w) in (m, m + 1))
    shard = np.sort(np.arange(len(words)) % many)
    i, j = spelling.near(words, shard, np.full(len(words), m), np.full(len(words), before))
    differ = lambda a, b: a[:before] != b[:before] or before > min(len(a), len(b))
    want = {
        (a, b) for a, x in enumerate(words) for b, y in enumerate(words)
        if shard[a] == shard[b] and apart(x, y) and differ(x, y) and m in (len(x), len(y))
    }
    got = list(zip(i.tolist(), j.tolist()))
    assert len(got) == len(set(got)) and set(got) == want


def test_very_long_words_and_none(spark):
    rows = [(n, "y" * 100_000 + " " + "y" * 100_001) for n in range(6)]
    check(spark, rows)
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, "some words here"), (2, None)])).count() == 0
