from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from hackney.llm import decontaminate
from tests.llm.helpers import ODD, documents, prose

ITEMS = "item_id bigint, text string, fingerprint string, found int"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(rows, items, window=10):
    windows = []
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        windows += [(tuple(w[i : i + size]), "" if item is None else str(item)) for i in range(len(w) - size + 1) if size]
    lines = [(words(text), "" if item is None else str(item)) for item, text in items]
    out = []
    for doc_id, text in rows:
        w = words(text)
        hit, names, starts = set(), set(), set()
        for size in {len(x) for x, _ in windows}:
            at = {}
            for i in range(len(w) - size + 1):
                at.setdefault(tuple(w[i : i + size]), []).append(i)
            for x, name in windows:
                if len(x) == size and x in at:
                    names.add(name)
                    hit.update(i + k for i in at[x] for k in range(size))
                    starts.update(at[x])
        longest = 0
        for line, _ in lines:
            size = min(window, len(line)) or 1
            for i in starts:
                for j in range(len(line) - size + 1):
                    k = 0
                    while i + k < len(w) and j + k < len(line) and w[i + k] == line[j + k]:
                        k += 1
                    longest = max(longest, k)
        out.append((doc_id, len(w), len(hit), tuple(sorted(names)), longest))
    return Counter(out)


def check(spark, rows, items, **options):
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEMS)
    found = decontaminate.find(documents(spark, rows), bench, **options).collect()
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.items), r.longest.words if r.longest else 0) for r in found)
    assert got == plain(rows, items)
    by_row = Counter((r.doc_id, r.n_hit) for r in found)
    for r in found:
        assert sum(s.after - s.first for s in r.spans) == r.n_hit
    left = decontaminate.clean(documents(spark, rows), bench, **options)
    assert left.columns == documents(spark, []).columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(
        d for (d, n), k in by_row.items() for _ in range(k) if n == 0
    )


def cases(seed):
    rng = random.Random(seed)
    items = [(n, prose(1000 + n, rng.choice([3, 9, 10, 11, 30, 60]), 60)) for n in range(25)]
    items += [(90, "Short One"), (91, None), (92, " .,;"), (93, items[0][1]), (None, "no name but of many words, more than ten are here at least")]
    rows = []
    for n in range(120):
        text = prose(n, rng.choice([5, 40, 90]), 60)
        if n % 2:
            w = (items[rng.randrange(25)][1]).split(" ")
            a = rng.randrange(len(w))
            part = " ".join(w[a : a + rng.randrange(5, 40)])
            text = text[: len(text) // 2] + " " + rng.choice([part, part.upper(), part.replace(" ", ", ")]) + " " + text[len(text) // 2 :]
        rows.append((n, text))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_and_items(spark, seed):
    rows, items = cases(seed)
    check(spark, rows + [(200, "a short one.")] + ODD[:8] + rows[:2], items)


def test_blocks_and_small_shards(spark, monkeypatch):
    rows, items = cases(3)
    monkeypatch.setattr(decontaminate, "SHARD", 500)
    check(spark, rows, items, block=700)


def test_words_that_repeat(spark):
    rows = [(n, "the " * (n * 5)) for n in range(12)] + ODD[8:]
    check(spark, rows, [(1, "the " * 25), (2, "the the the"), (3, "a " + "the " * 12)])


def test_very_long_text(spark):
    text = "the and " * 200_000 + prose(5, 40, 3000)
    bench = spark.createDataFrame([(1, prose(5, 40, 3000), "", 0), (2, "the and " * 8, "", 0)], ITEMS)
    [row] = decontaminate.find(documents(spark, [(1, text)]), bench).collect()
    assert row.n_words == 400_040 == row.n_hit
    assert row.longest.words == 40 and row.longest.first == 400_000 and row.items == ["1", "2"]


def test_suffix_array():
    rng = np.random.default_rng(1)
    line = rng.integers(0, 3, 500).astype(np.int32)
    order = decontaminate.suffix_array(line, 500).tolist()
    assert order == sorted(range(500), key=lambda i: line[i:].tolist())


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], ITEMS)
    docs = documents(spark, ODD)
    assert {r.n_hit for r in decontaminate.find(docs, empty).collect()} == {0}
    assert decontaminate.clean(docs, empty).count() == len(ODD)
    assert decontaminate.find(documents(spark, []), empty).count() == 0
