from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from hackney.llm import queries, simhash
from hackney.llm.components import components
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, documents, edited, prose


def plain_fingerprint(text: str | None) -> int:
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int]) -> list[int]:
    """For each distinct value the smallest position it reaches."""
    root = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return root


def check(spark, rows):
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = sorted({plain_fingerprint(t) for _, t in rows})
    root = dict(zip(prints, plain_components(prints)))
    least: dict[int, int] = {}
    for i, t in rows:
        r = root[plain_fingerprint(t)]
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = Counter((i, plain_fingerprint(t), least.get(root[plain_fingerprint(t)])) for i, t in rows)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want


def test_near_copies_and_odd_rows(spark):
    rows = list(ODD)
    for n in range(40):
        text = prose(n, 400)
        rows += [(1000 - n, text), (100 + n, edited(text, n, 1)), (2000 + n, edited(text, n + 50, 2))]
    check(spark, rows + [(9, "The End"), (8, "the  end")])


def test_no_documents(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def signed(values):
    return [(v - 2**64 if v >= 2**63 else v,) for v in values]


def test_rows_in_proportion_to_fingerprints(spark):
    """A shard is expected to stay one tree, so every fingerprint makes a row per key and no more."""
    assert [simhash.bands_for(n) for n in (10**6, 10**8, 10**12)] == [4, 5, 6]
    for many in (10**k for k in range(3, 15)):
        bands = simhash.bands_for(many)
        assert many / 2 ** (64 * (bands - 3) // bands) <= simhash.SHARD and math.comb(bands, 3) <= 56
    rng = random.Random(6)
    # Of 16 low bits that vary alone, four bands make few shards of many blocks; the rows are counted.
    df = spark.createDataFrame([(v * 3,) for v in range(3000)], "fp bigint")
    rows = {bands: simhash.dealt(df, shard=64, bands=bands).count() for bands in (4, 8)}
    assert rows[4] > 3000 * 3 * 40 and rows[8] > 3000
    wide = spark.createDataFrame(signed({rng.getrandbits(64) for _ in range(3000)}), "fp bigint")
    assert simhash.dealt(wide, shard=64).count() < 3000


@pytest.mark.parametrize("bands", [None, 5, 6, 8])
def test_a_shard_of_many_trees_loses_no_link(spark, bands):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(25)}
    # A third share a band, so that shards are cut into trees.
    values |= {rng.getrandbits(48) << 16 | 7 for _ in range(250)}
    values = sorted(values)
    df = spark.createDataFrame(signed(values), "fp bigint")
    found = simhash.links(df, shard=16, bands=bands)
    for a, b in found.collect():
        assert a != b
    roots = {r.node % 2**64: r.root for r in components(found).collect()}
    groups: dict[int, set[int]] = {}
    for v, r in zip(values, plain_components(values)):
        groups.setdefault(r, set()).add(v)
    mine: dict[int, set[int]] = {}
    for v in values:
        mine.setdefault(roots.get(v, v - 2**64 if v >= 2**63 else v), set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_trees_follow_only_edges_within_the_radius():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    shard = np.sort(rng.integers(0, 5, len(values)))
    shard = np.unique(shard, return_inverse=True)[1]
    tree = simhash.plant(values, shard)
    found = {(int(q), int(n)) for qs, ns in simhash.search(tree, values, values, shard, 24) for q, n in zip(qs, ns)}
    near = {
        (i, j)
        for i in range(len(values))
        for j in range(len(values))
        if shard[i] == shard[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 24
    }
    assert found == near


def test_the_registered_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = sorted({plain_fingerprint(r.text) for r in docs})
    root, least = dict(zip(prints, plain_components(prints))), {}
    for r in docs:
        k = root[plain_fingerprint(r.text)]
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    found = queries.QUERIES["op2_simhash_components"](spark, SF_DIR).collect()
    want = {(r.doc_id, f"{plain_fingerprint(r.text):016x}", least[root[plain_fingerprint(r.text)]]) for r in docs}
    assert {tuple(r) for r in found} == want and len(found) == len(docs)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 499), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 1 for i in range(2, 61)} | {100 + i: 100 for i in range(1, 50)} | {500: 499}
    assert got == want
