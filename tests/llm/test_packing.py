from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hackney.llm import packing, queries
from hackney.llm.encoder import Encoder
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("a 's\n\tréT0\xa0 <|endoftext|>'ll"))
def test_ids_are_those_of_the_library(library, text):
    assert [*np.frombuffer(Encoder_.encode(text.encode()), "<u4"), 2] == ids(library, text)


Encoder_ = Encoder(PATH)


def filled(steps, counts, capacity):
    """Contents of all sequences of a plan, after checking that it places every piece once."""
    seen, at = defaultdict(list), defaultdict(list)
    for s in steps:
        for k in range(s.count):
            seen[s.length].append(s.first + k)
            at[s.sequence + k // s.each].append((s.offset + k % s.each * s.length, s.length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(v)) for k, v in counts.items() if v}
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(at) == list(range(len(at)))
    return [sorted(length for _, length in parts) for parts in at.values()]


def fewest(items, capacity):
    """Smallest number of sequences, by trying all."""
    best = len(items)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[k] -= items[i]
            go(i + 1, rooms)
            rooms[k] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    items = sorted(items, reverse=True)
    go(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_never_costs_a_sequence(items):
    made = packing._Plan(Counter(items), 20)
    made.reduce()
    rest = [length for length, n in made.left.items() for _ in range(n)]
    assert made.sequences + fewest(rest, 20) == fewest(items, 20)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_every_plan_is_whole_and_no_worse_than_first_fit(counts):
    bins = filled(packing.plan(counts, 64), counts, 64)
    items = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)
    rooms: list[int] = []
    for x in items:
        fits = [k for k, r in enumerate(rooms) if r >= x]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= x
        else:
            rooms.append(64 - x)
    assert len(bins) <= len(rooms) + 1


def test_reduction_fixes_sets_of_one_two_and_three():
    made = packing._Plan({20: 2, 15: 3, 5: 2, 8: 1, 7: 1, 4: 1}, 20)
    made.reduce()
    assert made.sequences >= 5


def check(placed, rows, library):
    """``placed`` holds every piece of every document once; returns the number of sequences."""
    want = Counter()
    for i, text in rows:
        all_ids = ids(library, text)
        first = len(all_ids) % 1024 or 1024
        cuts = [0, *range(first, len(all_ids), 1024), len(all_ids)] if len(all_ids) > 1024 else [0, len(all_ids)]
        for n, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[i, n, a, b - a, zlib.crc32(np.array(all_ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == want
    at = defaultdict(list)
    for r in placed:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    return len(at)


def test_odd_rows(spark, library):
    rng = random.Random(2)
    rows = ODD + [(100 + n, prose(n, rng.choice([3, 50, 300, 900]))) for n in range(150)]
    packed = packing.pack(documents(spark, rows), PATH)
    with_crc = [r for r in packed.selectExpr("*", "crc32(ids) AS ids_crc32").collect()]
    check(with_crc, rows, library)
    parts = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in with_crc:
        whole = parts[r.sequence_id].ids
        assert bytes(whole[4 * r.offset : 4 * (r.offset + r.length)]) == bytes(r.ids)


def test_no_documents(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_query_packs_the_whole_table_well(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    placed = queries.QUERIES["op7_best_fit_packing"](spark, SF_DIR).collect()
    used = check(placed, [(r.doc_id, r.text) for r in docs], library)
    least = -(-sum(r.length for r in placed) // 1024)
    assert used <= least + 1 + least // 100
