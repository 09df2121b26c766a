from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.llm import queries, toxicity
from tests.llm.helpers import ODD, documents, prose


def plain_segments(scores):
    """Maximal scoring segments by their definition: the best one, and the same on its left and right."""
    def go(lo, hi):
        best = max(
            ((sum(scores[a : b + 1]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a, hi)), default=(0,)
        )
        if best[0] <= 0:
            return []
        *_, a, b = best
        return [*go(lo, a), (best[0], a, b), *go(b + 1, hi)]

    return go(0, len(scores))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=25))
def test_segments_are_all_maximal_ones(values):
    # Weights that differ slightly, so that no two segments score the same.
    scores = np.array([v + 1e-5 * (i + 1) ** 2 * (1 if v > 0 else -1) for i, v in enumerate(values)])
    got = toxicity.segments(scores)
    want = plain_segments(scores.tolist())
    assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
    assert np.allclose([s for s, *_ in got], [s for s, *_ in want])


def test_segments_in_linear_time():
    n = 400_000
    for scores in (np.tile([1.0, -2.0], n), np.tile([1.0, -0.5], n), np.r_[np.tile([1.0, -1.1], n), n], np.arange(n, 0, -1) - n / 2):
        assert toxicity.segments(np.array(scores, float))


def table(n=900):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(i, rng.choice([30, 200, 500])).split(" "), i % 6 == 0
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vilest", "rotten", "nastyish", "nastyous"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = table()
    known = spark.createDataFrame(labels + [(1, None), (None, 1), (2, 0)], "doc_id bigint, toxic int")
    return rows, dict(labels), toxicity.fit(documents(spark, rows), known)


def test_held_out_documents(spark, fitted):
    rows, labels, model = fitted
    found = toxicity.score(documents(spark, rows).withColumn("passages", F.lit(1)), model).collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((r.score >= toxicity.THRESHOLD) == labels[r.doc_id] for r in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    words = [r.text[p.start : p.end] for r in held if labels[r.doc_id] for p in r.passages]
    assert words and all(any(w in x for w in ("vilest", "rotten", "nasty")) for x in words)


def test_odd_rows(spark, fitted):
    *_, model = fitted
    rows = ODD + [(1, "nastyous")]
    found = toxicity.score(documents(spark, rows), model).collect()
    assert sorted((repr(r.doc_id), r.text or "") for r in found) == sorted((repr(i), t or "") for i, t in rows)
    assert len({r.score for r in found if not r.text}) == 1
    assert max(found, key=lambda r: r.score).text == "nastyous"
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_words_that_are_never_clean_have_finite_scores():
    tokens = [*("vilest"[:n] for n in range(3, 7)), "vilest$", "fin", "fine$"]
    toxic = np.array([[10**9]] * 5 + [[0]] * 2)
    scores = toxicity.log_odds(tokens, toxic, np.full((7, 1), 10**9), np.array([0.1]))
    assert np.isfinite(scores).all() and (scores[:5] > 5).all() and (scores[5:] < -5).all()


def test_tokens_left_out_change_no_score_by_much():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcd", k=rng.randrange(3, 11))) for _ in range(800)]
    tokens = sorted({w[:n] for w in words for n in range(3, 9) if len(w) >= n} | {w + "$" for w in words})
    every = np.array([[rng.randrange(2, 60)] * 2 for _ in tokens])
    scores = toxicity.log_odds(tokens, np.array([[rng.randrange(0, n + 1) if rng.random() < 0.3 else 0] * 2 for n, _ in every]), every, np.array([0.1, 0.1]))
    kept = toxicity.telling(tokens, scores)
    assert 0 < len(kept) < len(tokens)
    whole, some = toxicity.Odds(tokens, scores[:, 0]), toxicity.Odds([tokens[i] for i in kept], scores[kept, 0])
    more = words + ["".join(rng.choices("abcd", k=8)) for _ in range(500)]
    assert np.abs(whole(more) - some(more)).max() < toxicity.SAME


def test_recall_with_and_without_the_tokens_that_say_nothing_new(spark, fitted, monkeypatch):
    rows, labels, model = fitted
    monkeypatch.setattr(toxicity, "telling", lambda tokens, scores, before: np.arange(len(tokens)))
    known = spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")
    full = toxicity.fit(documents(spark, rows), known)
    assert len(model.tokens) < len(full.tokens)
    caught = []
    for m in (model, full):
        found = toxicity.score(documents(spark, rows), m).collect()
        caught.append({r.doc_id for r in found if r.score >= toxicity.THRESHOLD and zlib.crc32(str(r.doc_id).encode()) % 3 == 1})
    assert caught[0] == caught[1]


def plain_score(model, text):
    """Features and probability of a text, from the definitions."""
    words = re.findall(r"\w+", (text or ""))
    words = [w.lower() for w in words]
    odds = dict(zip(model.tokens, model.scores[:, -1].tolist()))
    scores, seen = [], Counter()
    for w in words:
        known = [odds.get(w + "$")] + [odds.get(w[:n]) for n in range(min(8, len(w)), 2, -1)]
        s = next((x for x in known if x is not None), 0.0)
        if s > toxicity.DROP:
            seen[w] += 1
            s /= seen[w]
        scores.append(s - toxicity.DROP)
    best = [s for s, _, _ in plain_segments(scores)]
    law, n = model.law, len(words)
    expected = lambda s: (n + 20) * math.exp(law.log_rate - law.decay * s)

    def surprise(many, mean):
        if not many:
            return 0.0
        below = sum(math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(many))
        return max(0.0, -math.log(max(1e-300, 1 - below)))

    beyond = math.log1p(sum(max(0.0, s - 2) for s in best))
    x = [1.0, max(-6.0, -math.log(expected(max(best)))) if best else -6.0]
    x += [math.sqrt(surprise(sum(s >= q for s in best), expected(q))) for q in toxicity.LEVELS]
    size = math.log(n + 20)
    x += [beyond, 10 * math.expm1(beyond) / (n + 50), size, beyond * size / 6]
    z = ((np.array(x) - model.middle) / model.spread) @ model.weights
    return 1 / (1 + math.exp(-z))


def test_scores_are_those_of_a_plain_version(spark, fitted):
    rows, _, model = fitted
    some = [r for r in rows if len(r[1]) < 1200][:60] + [(7, None), (8, ""), (9, "vilest"), (10, "Nastyish, ROTTEN vilest vilest.")]
    found = {(r.doc_id, r.text): r.score for r in toxicity.score(documents(spark, some), model).collect()}
    for i, text in some:
        assert found[i, text] == pytest.approx(plain_score(model, text), rel=1e-4, abs=1e-6)


def test_labels_of_one_kind_or_none(spark):
    docs = documents(spark, [(i, "some words") for i in range(20)])
    for labels in ([], [(i, 0) for i in range(20)], [(i, 1) for i in range(20)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    empty = toxicity.fit(documents(spark, []), spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int"))
    assert toxicity.score(docs, empty).count() == 20


def test_query_learns_from_the_rest_and_is_right_on_what_is_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op6_toxic_segments"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = found.join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    caught = [r for r in held if r.predicted]
    toxic = [r for r in held if r.toxic]
    assert sum(r.toxic for r in caught) >= 0.95 * len(caught)
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert all(r.predicted == (r.score >= 0.7) for r in held)
