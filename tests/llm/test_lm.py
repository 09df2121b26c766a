from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hackney.llm import lm, queries
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, documents, prose


def plain_log_probabilities(model, text):
    """Word by word, with softmaxes over all classes and all members written out."""
    numbers, net = lm.Numbers(model.words), model.network
    ids = [lm.OUTSIDE] * 2 + numbers.ids(text.encode()).tolist() + [lm.OUTSIDE] * 2
    out = []
    for i in range(2, len(ids) - 2):
        inside = np.tanh(sum(net.around[k][ids[i + p]].astype(float) for k, p in enumerate(lm.PLACES)))
        by_class = inside @ net.to_class + net.class_bias
        group = ids[i] // lm.MEMBERS
        by_member = inside @ net.to_member + net.member_bias[group]
        total = sum(
            math.exp(s[k]) / sum(map(math.exp, s)) for s, k in [(by_class, group)]
        ) * math.exp(by_member[ids[i] % lm.MEMBERS]) / sum(map(math.exp, by_member))
        out.append(math.log(total))
    return out


def chain(seed, words):
    """Text in which each word narrows down the next."""
    rng, now, out = random.Random(seed), 0, []
    for _ in range(words):
        now = (now * 5 + rng.randrange(3)) % 97
        out.append(f"w{now}")
    return " ".join(out)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = documents(spark, [(i, chain(i, 400)) for i in range(400)]).repartition(5)
    return lm.fit(docs)


def test_scores_are_those_word_by_word(spark, fitted):
    rows = ODD[:-2] + [(50, chain(1000, 60)), (51, "w1 W2 unknown " * 30)]
    found = {(r.doc_id, r.n_tokens): r for r in lm.score(documents(spark, rows), fitted).collect()}
    for i, text in rows:
        want = plain_log_probabilities(fitted, text or "")
        r = found[i, len(want)]
        assert r.score == pytest.approx(sum(want), rel=1e-4, abs=1e-6)
        assert r.per_token == (pytest.approx(sum(want) / len(want), rel=1e-4) if want else None)


def test_order_of_words_is_learnt(spark, fitted):
    rng, rows = random.Random(3), []
    for i in range(40):
        words = chain(5000 + i, 100).split(" ")
        rows.append((2 * i, " ".join(words)))
        rng.shuffle(words)
        rows.append((2 * i + 1, " ".join(words)))
    score = {r.doc_id: r.per_token for r in lm.score(documents(spark, rows), fitted).collect()}
    assert all(score[2 * i] > score[2 * i + 1] + 1 for i in range(40))
    # Words that are alike but for order would have the logarithm of 1/97.
    assert sum(score[2 * i] for i in range(40)) / 40 > -3.5


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    net = lm.Network.start(rng.integers(1, 50, lm.IDS))
    net = lm.Network(*(p.astype(np.float64) for p in net.parts()))
    target = rng.integers(0, lm.IDS, 40).astype(np.int16)
    context = rng.integers(0, 30, (4, 40)).astype(np.int16)
    back, slopes = net.gradients(context, target)
    loss = lambda: -net.log_probability(context, target).sum()
    around = np.zeros_like(net.around)
    for place in range(4):
        np.add.at(around[place], context[place], back)
    for part, slope in zip(net.parts(), [around, *slopes]):
        for at in map(tuple, np.argwhere(np.abs(slope) > 0)[:: max(1, slope.size // 20)][:20]):
            before = part[at]
            part[at] = before + 1e-5
            up = loss()
            part[at] = before - 1e-5
            down = loss()
            part[at] = before
            assert (up - down) / 2e-5 == pytest.approx(slope[at], rel=1e-3, abs=1e-4)


def test_large_weights_do_not_overflow():
    rng = np.random.default_rng(2)
    net = lm.Network.start(rng.integers(1, 50, lm.IDS))
    net.to_class *= 1e4
    net.member_bias[:] -= 500
    target, context = rng.integers(0, lm.IDS, 50).astype(np.int16), rng.integers(0, 30, (4, 50)).astype(np.int16)
    wide = lm.Network(*(p.astype(np.float64) for p in net.parts()))
    assert np.allclose(net.log_probability(context, target), wide.log_probability(context, target), rtol=1e-3, atol=1e-2)


def test_words_of_many_texts_are_those_of_each(monkeypatch):
    """In portions of any size; a rare word has its id made once, however often it is there."""
    texts = [t for _, t in ODD] + [" \x0b a\x0cB\rc\x1cd\x85e\xa0f \n", "", " \t", None, "ÄB ßc", "x" * 300, chain(3, 200)]
    plain = [(t or "").encode().lower().split() for t in texts]
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(lm, "PORTION", size)
        found = []
        for part in lm.portions(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})):
            words, ends = lm.words_of(part["text"])
            words = words.cast(pa.binary()).to_pylist()
            found += [words[a:b] for a, b in zip(ends[:-1], ends[1:])]
        assert found == plain
    made, shared = [], lm.Numbers.shared
    monkeypatch.setattr(lm.Numbers, "shared", staticmethod(lambda word: made.append(word) or shared(word)))
    ids = lm.Numbers(["a"]).ids(b"zq A zr " * 500)
    assert ids.tolist() == [shared(b"zq"), 0, shared(b"zr")] * 500 and sorted(made) == [b"zq", b"zr"]


def test_a_step_moves_every_embedding_by_the_sum_of_its_slopes():
    """As one place after the other and one word after the other would; batches of a size share their arrays."""
    rng = np.random.default_rng(4)
    start = lm.Network.start(rng.integers(1, 50, lm.IDS))
    trainer = lm.Trainer(start.unpack(start.pack()), start.filled(1e-2))
    target, context = rng.integers(0, lm.IDS, 300).astype(np.int16), rng.integers(0, 90, (4, 300)).astype(np.int16)
    context[:, ::7] = lm.OUTSIDE
    back, slopes = start.gradients(context, target)
    around = np.zeros_like(start.around)
    for place in range(4):
        np.add.at(around[place], context[place], back)
    trainer.step(context, target)
    for before, part, seen, slope in zip(start.parts(), trainer.network.parts(), trainer.seen.parts(), [around, *slopes]):
        slope = slope / np.sqrt(300)
        assert np.allclose(seen, 1e-2 + slope**2, rtol=1e-4)
        assert np.allclose(part, before - lm.RATE * slope / np.sqrt(1e-2 + slope**2), rtol=1e-4, atol=1e-6)
    inside = start._forward(context, target)[0]
    assert np.shares_memory(inside, start._forward(context, target)[0])


def test_probabilities_add_up_to_one(fitted):
    target = np.arange(lm.IDS, dtype=np.int16)
    context = np.tile(np.array([[3], [70], [1999], [lm.OUTSIDE]], np.int16), lm.IDS)
    assert np.exp(fitted.network.log_probability(context, target)).sum() == pytest.approx(1, rel=1e-4)


def test_vocabulary_counts_the_whole_corpus(spark):
    rows = ODD + [(i, prose(i, 50)) for i in range(60)]
    counts = Counter(w.decode() for _, t in rows for w in (t or "").encode().lower().split())
    found = lm.vocabulary(documents(spark, rows))
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: lm.IDS - lm.SHARED]
    assert found[:-1] == order and found[-1][1] == counts.total() - sum(n for _, n in order)


@pytest.mark.parametrize("near", [lm.NEAR, 700, 0])
def test_rare_words_have_their_own_probability(spark, monkeypatch, near):
    """Whether a word's count is at hand or joined; words outside the corpus come behind all others of their id."""
    monkeypatch.setattr(lm, "NEAR", near)
    often = [f"a{n}" for n in range(lm.IDS - lm.SHARED)] * 6
    rare = [f"r{n}" for n in range(1500) for _ in range(1 + n % 5)]
    corpus = [(1, " ".join(often)), (2, " ".join(rare)), (2, " ".join(rare[:10]))]
    model = lm.fit(documents(spark, corpus))
    assert len(model.rare.near) <= near and bool(model.rare.near) == (near > 0)
    counts = Counter(w for _, t in corpus for w in t.split())
    shared = {w: lm.Numbers.shared(w.encode()) for w in counts if w[0] == "r"}
    slots = {}
    for word, slot in shared.items():
        slots.setdefault(slot, []).append(word)

    def share(word):
        if word in model.words:
            return 0.0
        members = slots.get(lm.Numbers.shared(word.encode()), [])
        all_of_it = 1 + sum(counts[w] for w in members)
        return math.log(counts[word] / all_of_it if word in counts else 1 / all_of_it / (1 + len(members)))

    gibberish = [next(f"zq{k}" for k in range(10**6) if lm.Numbers.shared(b"zq%d" % k) == shared[w]) for w in ("r0", "r5")]
    rows = [(i, w) for i, w in enumerate(["r0", "r4", "R4 a1 r4", *gibberish, "r1 zq0 zq0 zq1 r5", "a0", ""])]
    rows += [(None, "r3"), (None, "r3"), (50, " ".join(rare))]
    found = Counter((r.doc_id, r.n_tokens, round(r.score, 2)) for r in lm.score(documents(spark, rows), model).collect())
    want = [(i, len(t.split()), sum(plain_log_probabilities(model, t)) + sum(map(share, t.lower().split()))) for i, t in rows]
    assert sum(found.values()) == len(want)
    for i, n, total in want:
        assert any(key[:2] == (i, n) and key[2] == pytest.approx(total, rel=1e-4, abs=0.01) for key in found)
    alone = {r.doc_id: r.score for r in lm.score(documents(spark, [(0, "r0"), (1, gibberish[0])]), model).collect()}
    assert alone[0] > alone[1] + 0.5


def mean_score(spark, docs, model):
    rows = lm.score(docs, model).agg(F.sum("score").alias("score"), F.sum("n_tokens").alias("n")).first()
    return rows["score"] / rows["n"]


def test_training_helps_whatever_the_layout(spark, monkeypatch):
    """On texts that were not learnt from, better than the start, with 1, 8 and 64 partitions all but the same."""
    monkeypatch.setattr(lm, "COPY", 10_000)
    docs = documents(spark, [(i, chain(i, 200)) for i in range(1200)])
    new = documents(spark, [(i, chain(10**6 + i, 200)) for i in range(100)])
    words, rare, start = lm._vocabulary(docs)
    first = mean_score(spark, new, lm.Model(words, start, rare))
    found = [mean_score(spark, new, lm.fit(docs.repartition(n))) for n in (1, 8, 64)]
    # 240,000 words are 8 rounds of 3 copies.
    assert min(found) > first + 1
    assert max(found) - min(found) < 1e-3


def test_a_row_that_is_a_third_of_all_is_dealt_over_copies(spark, monkeypatch):
    monkeypatch.setattr(lm, "COPY", 4000)
    rows = [(1, chain(1, 100))] * 200 + [(i, chain(i, 100)) for i in range(2, 400)]
    paths, written = [], lm.scratch
    monkeypatch.setattr(lm, "scratch", lambda s, label: paths.append(written(s, label)) or paths[-1])
    lm.fit(documents(spark, rows).repartition(5))
    texts = spark.read.parquet(next(p for p in paths if "/rounds-" in p))
    sizes = [r["n"] for r in texts.groupBy("round", "copy").agg(F.sum(F.octet_length("ids") / 2).alias("n")).collect()]
    assert sum(sizes) == 598 * 100 and max(sizes) < 2.5 * 4000


def test_copies_are_averaged_in_a_tree(spark, fitted, monkeypatch):
    monkeypatch.setattr(lm, "FAN_IN", 2)
    monkeypatch.setattr(lm, "COPY", 100)
    docs = documents(spark, [(i, chain(i, 50)) for i in range(40)]).repartition(7)
    model = lm.fit(docs)
    assert model.network.around.shape == fitted.network.around.shape
    assert np.isfinite(np.frombuffer(model.network.pack(), "<f4")).all()


def test_no_documents(spark, fitted):
    empty = documents(spark, [])
    assert lm.score(empty, fitted).count() == 0
    model = lm.fit(documents(spark, [(1, None), (2, " ")]))
    assert [r.score for r in lm.score(documents(spark, [(1, ""), (2, None)]), model).collect()] == [0, 0]
    assert lm.fit(empty).words == []


def test_query_scores_every_document(spark):
    found = queries.QUERIES["op8_masked_lm"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert {r.doc_id: r.n_tokens for r in found} == {r.doc_id: len(r.text.encode().split()) for r in docs}
    assert all(r.score < 0 for r in found)


def test_query_scores_are_those_of_a_plain_version(spark):
    """All documents of the table, word by word, with the counts of rare words."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = lm.fit(docs)
    counts = Counter(w for t in texts.values() for w in t.encode().lower().split())
    known, slots = {w.encode() for w in model.words}, Counter()
    for w, n in counts.items():
        if w not in known:
            slots[lm.Numbers.shared(w)] += n
    found = {r.doc_id: r for r in queries.QUERIES["op8_masked_lm"](spark, SF_DIR).collect()}
    for doc_id, text in list(texts.items())[::7]:
        words = text.encode().lower().split()
        rare = sum(math.log(counts[w] / (1 + slots[lm.Numbers.shared(w)])) for w in words if w not in known)
        want = sum(plain_log_probabilities(model, text)) + rare
        assert found[doc_id].score == pytest.approx(want, rel=1e-3)
