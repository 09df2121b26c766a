"""Toxicity: the passages of a text whose words speak most for it.

A word's score is its log-odds between toxic and other documents, with Dirichlet priors in a chain: the
prior of a word is what its beginning says, the prior of that what a shorter beginning says, down to
the share of words in toxic documents. Less a constant drop per word, so that scores are negative on
average, one linear pass finds all maximal scoring segments (after Ruzzo and Tompa). How many segments of
a score a clean text of some length has by chance follows an extreme-value law, fitted to clean
documents; what a text has beyond that is turned into a probability by a logistic regression.
All fitting is by folds: a document is scored by words learnt from others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import small, stored, texts_of
from hackney.operators.sketch import quantiles, sketch

#: Labelled documents that the classifier is fitted on, at most; taken by a hash of their ids.
LABELLED = 20_000
#: A token whose score is this close to that of its longest kept beginning is left out, as that stands for it then.
SAME = 0.1
#: Documents that a beginning must occur in.
SUPPORT = 2
FOLDS = 4
#: Weight of the prior, in occurrences.
PRIOR = 3.0
#: The least chance that a word speaks for the other side.
DOUBT = 1e-4
#: The least score of a word.
LEAST = -1.0
#: Taken off every word's score.
DROP = 1.0
#: Occurrences in a document that count at most.
BURST = 5
THRESHOLD = 0.7
#: Scores at which segments are counted.
LEVELS = (1.0, 2.0, 3.0, 4.5)
#: A passage is significant if so many as good are expected in a clean text at most.
SIGNIFICANT = 0.01

_LENGTHS = range(3, 9)
_WORD = re.compile(r"\w+")
_WHOLE = "$"


def words_of(text: bytes) -> list[str]:
    words = _WORD.findall(text.decode())
    # Lower case may change a word's length, so it comes second, for all words at once.
    return " ".join(words).lower().split(" ") if words else []


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learnt from; none without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _fold(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("fold")), F.lit(FOLDS)).cast("int")


def _longest(word: str, known: dict, other):
    """What is known for the longest beginning of the word."""
    for n in range(min(len(word), _LENGTHS[-1]), _LENGTHS[0] - 1, -1):
        if (found := known.get(word[:n])) is not None:
            return found
    return other


def beginnings(tokens: list[str]) -> np.ndarray:
    """The place of each token's longest beginning that is a token too, or -1."""
    place = {t: i for i, t in enumerate(tokens)}
    return np.fromiter((_longest(t[:-1], place, -1) for t in tokens), np.int64, len(tokens))


def _by_length(tokens: list[str]) -> Iterator[np.ndarray]:
    """Places of tokens of equal length; a beginning comes before what it begins."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    for size in np.unique(sizes):
        yield np.flatnonzero(sizes == size)


def log_odds(
    tokens: list[str], toxic: np.ndarray, every: np.ndarray, share: np.ndarray, before: np.ndarray | None = None
) -> np.ndarray:
    """Of all tokens, from their occurrences in toxic and in all documents, by column; ``share`` is that of words."""
    before = beginnings(tokens) if before is None else before
    chance = np.empty((len(tokens) + 1, len(share)))
    chance[-1] = share
    for at in _by_length(tokens):
        found = (toxic[at] + PRIOR * chance[before[at]]) / (every[at] + PRIOR)
        # Along a chain of beginnings that occur in one kind alone, doubt would shrink to nothing.
        chance[at] = np.clip(found, DOUBT, 1 - DOUBT)
    chance = chance[:-1]
    return np.log(chance / (1 - chance)) - np.log(share / (1 - share))


def telling(tokens: list[str], scores: np.ndarray, same: float = SAME, before: np.ndarray | None = None) -> np.ndarray:
    """Places of the tokens that say something else than their beginnings do, in any of the columns.

    A word's score without the other tokens is off by less than ``same``. How many are left goes by what they
    say, not by how many there are.
    """
    before = beginnings(tokens) if before is None else before
    # The longest kept beginning of each token, itself included; nothing, which comes last, scores 0.
    kept = np.full(len(tokens) + 1, len(tokens))
    known = np.vstack([scores, np.zeros((1, scores.shape[1]))])
    for at in _by_length(tokens):
        base = kept[before[at]]
        new = (np.abs(known[at] - known[base]) >= same).any(axis=1)
        kept[at] = np.where(new, at, base)
    return np.flatnonzero(kept[:-1] == np.arange(len(tokens)))


class Odds:
    """Scores of words: that of the whole word, else of its longest beginning, else 0."""

    def __init__(self, tokens: list[str], scores: np.ndarray, kept: int = 500_000) -> None:
        self._odds = dict(zip(tokens, scores.tolist()))
        self._words: dict[str, float] = {}
        self._kept = kept

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self._words) > self._kept:
            self._words = {}
        known = self._words
        found = list(map(known.get, words))
        if None in found:
            for i, word in enumerate(words):
                if found[i] is None:
                    score = self._odds.get(word + _WHOLE)
                    known[word] = found[i] = _longest(word, self._odds, 0.0) if score is None else score
        return np.array(found, float)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, last), in linear time.

    A candidate knows the last one before it whose left sum is lower, so that each is passed once.
    """
    sums = np.cumsum(scores)
    found: list[tuple[float, float, int, int, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        right = float(sums[i])
        left, first = right - float(scores[i]), i
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, i, j))
                break
            # The candidate and all behind it become one with the segment.
            left, _, first, _, before = found[j]
            del found[j:]
            j = before
    return [(right - left, first, last) for left, right, first, last, _ in found]


def scored_segments(odds: Odds, text: bytes) -> tuple[int, list[tuple[float, int, int]]]:
    """The number of words, and the segments; a word that returns says less each time."""
    words = words_of(text)
    scores = odds(words)
    seen: Counter[str] = Counter()
    for i in np.flatnonzero(scores > DROP).tolist():
        seen[words[i]] += 1
        scores[i] /= seen[words[i]]
    return len(words), segments(scores - DROP)


def _surprise(many: int, log_expected: float) -> float:
    """Minus the logarithm of the chance of ``many`` or more where so many are expected (Poisson)."""
    if many == 0:
        return 0.0
    expected = math.exp(log_expected)
    first = -expected + many * log_expected - math.lgamma(many + 1)
    total = term = 1.0
    k = many
    while term > 1e-12 * total:
        k += 1
        term *= expected / k
        total += term
    return max(0.0, -(first + math.log(total)))


@dataclass
class Law:
    """In a clean text of n words, ``n * exp(log_rate - decay * s)`` segments score s or more by chance."""

    decay: float = 1.0
    log_rate: float = -3.0

    @classmethod
    def fit(cls, words: int, levels: list[float], many: list[int]) -> Law:
        """From how ``many`` segments of clean texts score each of the ``levels`` or more."""
        some = sorted({level: n for level, n in zip(levels, many) if n}.items())
        if len(some) < 2:
            return cls()
        slope, at = np.polyfit([level for level, _ in some], np.log([n / words for _, n in some]), 1)
        return cls(max(0.05, float(-slope)), float(at))

    def log_expected(self, words: int, score: float) -> float:
        return math.log(words + 20) + self.log_rate - self.decay * score

    def features(self, words: int, scores: list[float]) -> list[float]:
        best = -self.log_expected(words, max(scores)) if scores else -6.0
        beyond = math.log1p(sum(max(0.0, s - 2) for s in scores))
        many = [sum(s >= q for s in scores) for q in LEVELS]
        counts = (math.sqrt(_surprise(n, self.log_expected(words, q))) for n, q in zip(many, LEVELS))
        size = math.log(words + 20)
        return [1.0, max(-6.0, best), *counts, beyond, 10 * math.expm1(beyond) / (words + 50), size, beyond * size / 6]


@dataclass
class Model:
    tokens: list[str]
    scores: np.ndarray
    """Log-odds of the tokens, learnt without each fold, and in the last column from all."""
    law: Law
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def odds(self, without: int = FOLDS) -> Odds:
        """The words' scores, learnt from all folds or from all but one."""
        return Odds(self.tokens, self.scores[:, without])

    def probability(self, features: list[list[float]]) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(features))
        x = (np.array(features) - self.middle) / self.spread
        # Row by row, so that equal texts have equal scores whatever else is in their batch.
        return 1 / (1 + np.exp(-np.clip((x * self.weights).sum(axis=1), -40, 40)))


def _regress(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's steps; the first column is 1."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    middle[0], spread[0] = 0, 1
    z, w = (x - middle) / spread, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        slope = (z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(w))
        w = w + np.linalg.solve(slope, z.T @ (y - p) - penalty * w)
    return middle, spread, w


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and occurrences by token, fold and label, added up per task; the empty token counts words."""
    slots = 2 * FOLDS
    held = [Counter() for _ in range(slots)]
    more = [Counter() for _ in range(slots)]
    for whole in batches:
        for batch in small(whole):
            for text, fold, label in zip(texts_of(batch), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                slot, words = 2 * fold + label, words_of(text)
                here = Counter(w + _WHOLE for w in words)
                for n in _LENGTHS:
                    here.update(w[:n] for w in words if len(w) >= n)
                held[slot].update(here.keys())
                more[slot].update({t: min(n, BURST) - 1 for t, n in here.items() if n > 1})
                more[slot][""] += len(words)
    for slot in range(slots):
        tokens = list(held[slot].keys() | more[slot].keys())
        for at in range(0, len(tokens), 100_000):
            part = tokens[at : at + 100_000]
            docs = np.fromiter(map(held[slot].__getitem__, part), np.int64, len(part))
            seen = docs + np.fromiter(map(more[slot].__getitem__, part), np.int64, len(part))
            columns = [pa.array(part, pa.string()), pa.array(np.full(len(part), slot, np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(docs), pa.array(seen)], ["token", "slot", "docs", "seen"])


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """Learn from the ``toxic`` labels (0 or 1; null: none) of documents that are not held out.

    ``most`` bounds the labelled documents used, which is the only bound on what is looked at: all their tokens that
    occur in ``SUPPORT`` documents are scored. If a document has several labels, the largest counts. Without both
    labels the model gives every text 0.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # ``most`` rows at most
    texts = stored(texts.select("text", _fold(F.col("doc_id")).alias("fold"), "toxic"), "labelled")
    counts = texts.mapInArrow(_count, "token string, slot int, docs bigint, seen bigint")
    by_slot = [F.sum(F.when(F.col("slot") == k, F.col("seen")).otherwise(0)).alias(f"s{k}") for k in range(2 * FOLDS)]
    sums = counts.groupBy("token").agg(F.sum("docs").alias("held"), *by_slot)
    sums = stored(sums.filter((F.col("held") >= SUPPORT) | (F.col("token") == "")), "tokens")
    slots = [f"s{k}" for k in range(2 * FOLDS)]
    words = sums.filter("token = ''").select(*slots).first()
    words = np.array(words or [1] * len(slots), np.int64).reshape(FOLDS, 2)
    # Tokens of ``most`` documents. A document has a token ``BURST`` times at most, so counts are small numbers.
    rows = sums.filter("token <> ''").select("token", *[F.col(c).cast("int").alias(c) for c in slots]).toArrow()
    tokens, nothing = rows["token"].to_pylist(), np.zeros(0)
    counts = np.stack([rows[c].to_numpy() for c in slots], axis=1).reshape(len(tokens), FOLDS, 2)
    del rows

    def without_each(values: np.ndarray) -> np.ndarray:
        """Sums without each fold in turn, and of all; folds are on the last axis."""
        whole = values.sum(axis=-1, keepdims=True)
        return np.concatenate([whole - values, whole], axis=-1)

    toxic_words, all_words = without_each(words[:, 1]), without_each(words.sum(axis=1))
    share = np.clip(toxic_words / np.maximum(all_words, 1), 1e-6, 1 - 1e-6)
    before = beginnings(tokens)
    scores = log_odds(tokens, without_each(counts[:, :, 1]), without_each(counts.sum(axis=2)), share, before)
    # How clean a clean word is says little.
    np.maximum(scores, LEAST, out=scores)
    del counts
    kept = telling(tokens, scores, before=before)
    model = Model([tokens[i] for i in kept.tolist()], scores[kept], Law(), nothing, nothing, nothing)
    del tokens, scores, before

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, odds = None, None
        for whole in batches:
            for batch in small(whole):
                found = []
                for f, text in zip(batch.column(1).to_pylist(), texts_of(batch)):
                    # One fold's scores at a time; the rows come by fold.
                    if f != fold:
                        fold, odds = f, model.odds(without=f)
                    found.append(scored_segments(odds, text))
                sizes = pa.array([n for n, _ in found], pa.int64())
                scores = pa.array([[s for s, _, _ in some] for _, some in found], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(2), sizes, scores], ["toxic", "words", "scores"])

    # By folds, of the labelled sample.
    sample = texts.sortWithinPartitions("fold").mapInArrow(score, "toxic int, words bigint, scores array<double>")
    sample = stored(sample, "segments")
    labelled = dict(map(tuple, sample.groupBy("toxic").agg(F.sum("words")).collect()))
    if len(labelled) == 2:
        model.law = _law(sample.filter("toxic = 0"), labelled[0])
        law = model.law

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [law.features(n, list(s)) for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["toxic", "x"])

        # A few numbers for each of ``most`` documents, in an order of their own.
        found = sorted((tuple(r["x"]), r["toxic"]) for r in sample.mapInArrow(features, "toxic int, x array<double>").collect())
        model.middle, model.spread, model.weights = _regress(np.array([x for x, _ in found]), np.array([y for _, y in found]))
    return model


def _law(clean: DataFrame, words: int) -> Law:
    """The law of the segments of clean texts, by their number above some quantiles of their scores."""
    scores = clean.select(F.explode("scores").alias("score"))
    shares = {f"q{i}": q for i, q in enumerate((0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99))}
    found = quantiles(sketch(scores, {"score": F.floor(F.col("score") * 1_000_000).cast("bigint")}), shares).first()
    if found is None or found["many"] < 50:
        return Law()
    levels = [found[name] / 1_000_000 for name in shares]
    many = scores.agg(*[F.count_if(F.col("score") >= level).alias(f"n{i}") for i, level in enumerate(levels)]).first()
    return Law.fit(words, levels, list(many))


_PASSAGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``passages``, the significant ones, in code points (end exclusive).

    Null and empty texts have the score of a text without a toxic word. Columns ``score`` and ``passages``
    that ``docs`` has are replaced. Rows are kept as they are, repeated ones and those without an id too.
    """
    others = [c for c in docs.columns if c not in ("score", "passages")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, law = model.odds(), model.law
        for whole in batches:
            for batch in small(whole):
                features, passages = [], []
                for text in texts_of(batch):
                    size, found = scored_segments(odds, text)
                    features.append(law.features(size, [s for s, _, _ in found]))
                    good = [x for x in found if law.log_expected(size, x[0]) <= math.log(SIGNIFICANT)]
                    places = [m.span() for m in _WORD.finditer(text.decode())] if good else []
                    passages.append([{"start": places[a][0], "end": places[b][1], "score": s} for s, a, b in good])
                columns = [pa.array(model.probability(features)), pa.array(passages, _PASSAGES)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*others, "score", "passages"])

    kept = docs.select(*others)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    added = "score double, passages array<struct<start: bigint, end: bigint, score: double>>"
    return kept.mapInArrow(run, f"{kinds}, {added}")
