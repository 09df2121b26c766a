"""Spelling variants: words one letter apart, found by a bit-sliced position index.

Words that differ by one inserted, deleted or replaced letter agree in the first or the last half of the
shorter one's letters, so all links lie within shards of words that share such a half. In a shard each
(position, letter) has a bitset of the words with that letter there. A word runs through them letter by letter:
one set holds the words that agree so far, three others those with one letter replaced, missing or more,
which go on in the bitsets at the same, the last or the next position. All words of many shards run at once,
64 candidates to a machine word.

A shard above ``SHARD`` words is halved again, as often as needed: the letters between what its words share
are split, and one half of those must agree. A shard that cannot be halved has one free letter, so it is bounded
by the alphabet. Of links that several halves would give, the first half's counts: the last half's shard takes
pairs only whose first letters differ before the first half ends.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import stored, texts_of

#: Code points and occurrences of a word at least.
SHORTEST, LEAST = 5, 3
#: Of the runs whose checksum this divides, a letter goes.
EVERY = 97
#: A form is this many times as frequent as the word at least.
TIMES = 2
#: Words of a shard from which on it is halved.
SHARD = 1024
#: Different words that a task counts before it passes them on.
HELD = 200_000
#: Letters of words that a task collects, shards being whole, before it searches them.
HELD_LETTERS = 300_000
#: Rows of a task that run through the index together, about.
FRONT = 100_000
#: Lower-case letters and U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def told() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for number, text in zip(batch.column(0), texts_of(batch)):
            doc_id = number.as_py()
            start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(_RUN.findall(text.lower())).items():
                if (h := zlib.crc32(run, start)) % EVERY == 0:
                    letters = run.decode()
                    at = h % len(letters)
                    run = (letters[:at] + letters[at + 1 :]).encode()
                counts[run] += n
            if len(counts) >= HELD:
                yield told()
                counts.clear()
    yield told()


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words that are long and frequent enough.

    A word is a run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in lower case. Of every 97th run of a document,
    by a checksum of ``doc_id`` (null: empty) and run, a letter is missing. Null texts have no runs.
    """
    counts = docs.select("doc_id", "text").mapInArrow(_count, "word string, n bigint")
    counts = counts.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.filter(F.col("n") >= least), "vocabulary")


def _halves(middle: Column, first: Column, last: Column, before: Column) -> Column:
    """The two halves of a shard: letters shared at the beginning, at the end, and where two words must differ before."""
    half = F.floor(middle / 2).cast("int")
    fields = ("first", "last", "before")
    one = F.struct(*(c.alias(n) for n, c in zip(fields, (first + half, last, before))))
    other = F.struct(*(c.alias(n) for n, c in zip(fields, (first, last + half, first + half))))
    return F.array(one, other)


KEY = ("m", "first", "last", "before", "head", "tail")


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with their halves ``part`` as rows of smaller shards."""
    rows = rows.select("word", "n", "m", "part.*")
    return rows.withColumns({
        "head": F.substring("word", F.lit(1), F.col("first")),
        "tail": F.when(F.col("last") > 0, F.expr("right(word, last)")).otherwise(""),
    })


def shards(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """``words`` once for each shard they belong to, with its ``KEY``; shards of one word are left out.

    ``m`` is the length of the shorter word of a pair: a word goes as it is, and as the longer one.
    """
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"))
    none = F.lit(0)
    # No pair agrees in all the letters of the longer word, so at first this bars none.
    rows = rows.select("word", "n", "m", F.explode(_halves(F.col("m"), none, none, F.col("m") + 2)).alias("part"))
    rows, done = _dealt(rows), []
    while True:
        sizes = rows.groupBy(*KEY).agg(F.count("*").alias("many")).filter("many > 1")
        free = F.col("m") - F.col("first") - F.col("last")
        rows = stored(rows.join(sizes, list(KEY)).withColumn("large", (F.col("many") > shard) & (free >= 2)).drop("many"), "shards")
        done.append(rows.filter("NOT large").drop("large"))
        large = rows.filter("large")
        if large.isEmpty():
            break
        halves = _halves(free, F.col("first"), F.col("last"), F.col("before"))
        # Where two words must differ already is the stricter bound.
        split = large.select("word", "n", "m", F.col("before").alias("__before"), F.explode(halves).alias("part"))
        split = split.withColumn("part", F.col("part").withField("before", F.least("part.before", "__before")))
        rows = _dealt(split.drop("__before"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _letters(words: list[str], width: int) -> np.ndarray:
    """Code points by word and position, 0 behind the end."""
    out = np.zeros((len(words), width), np.int16)
    for i, word in enumerate(words):
        out[i, : len(word)] = np.frombuffer(word.encode("utf-32-le"), "<u4")
    return out


class Index:
    """The bitsets of the words of some shards, 64 to a lane: (lane, position, letter) to a machine word."""

    def __init__(self, letters: np.ndarray, lane: np.ndarray, bit: np.ndarray) -> None:
        self._width = letters.shape[1]
        word, position = np.nonzero(letters)
        key = self._key(lane[word], position, letters[word, position])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self._keys = key[first]
        one = np.left_shift(np.uint64(1), bit.astype(np.uint64))[word][order]
        self._sets = np.bitwise_or.reduceat(one, first) if len(first) else np.zeros(0, np.uint64)

    def _key(self, lane, position, letter):
        return (lane * self._width + position) * 512 + letter.astype(np.int64)

    def at(self, lane: np.ndarray, position: int, letter: np.ndarray) -> np.ndarray:
        """The words of each lane that have the letter at the position."""
        out = np.zeros(len(lane), np.uint64)
        if 0 <= position < self._width and len(self._keys):
            key = self._key(lane, position, letter)
            place = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            out = np.where(self._keys[place] == key, self._sets[place], out)
        return out


def near(words: list[str], shard: np.ndarray, m: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), both ways, of words in the same shard (numbers from 0, ascending) that are one letter apart.

    Only pairs count whose shorter word has ``m`` letters and that differ among the first ``before``.
    """
    length = np.fromiter(map(len, words), np.int64, len(words))
    letters = _letters(words, int(length.max(initial=0)) + 1)
    # Words get lanes of 64 within their shard, and every word runs through all lanes of its shard.
    sizes = np.bincount(shard)
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(len(words)) - begin[shard]
    lanes = -(-sizes // 64)
    first_lane = np.cumsum(lanes) - lanes
    lane, bit = first_lane[shard] + inside // 64, inside % 64
    index = Index(letters, lane, bit)
    members = np.bincount(lane, minlength=int(lanes.sum()))
    full = np.where(members == 64, ~np.uint64(0), np.left_shift(np.uint64(1), members.astype(np.uint64) % np.uint64(64)) - np.uint64(1))
    by_length: dict[int, np.ndarray] = {}
    for n in np.unique(length).tolist():
        mine = length == n
        by_length[n] = np.zeros(int(lanes.sum()), np.uint64)
        np.bitwise_or.at(by_length[n], lane[mine], np.left_shift(np.uint64(1), bit[mine].astype(np.uint64)))
    nothing = np.zeros(int(lanes.sum()), np.uint64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # Words of equal length run together.
    order = np.argsort(length, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
        if not len(group):
            continue
        n = int(length[group[0]])
        times = lanes[shard[group]]
        cuts = np.searchsorted(np.cumsum(times), np.arange(FRONT, int(times.sum()), FRONT))
        for part in np.split(group, np.unique(cuts)):
            times = lanes[shard[part]]
            query = np.repeat(part, times)
            here = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times) + first_lane[shard[query]]
            same = full[here]
            replaced, missing, more = (np.zeros(len(query), np.uint64) for _ in range(3))
            agree = np.zeros(len(query), np.uint64)
            bound = before[query]
            for at in range(n):
                letter = letters[query, at]
                if (bound == at).any():
                    agree = np.where(bound == at, same, agree)
                now, last, next_ = (index.at(here, at + step, letter) for step in (0, -1, 1))
                # One letter more: the candidate's letter here is passed over, and this one must come next.
                more = (more & next_) | (same & next_)
                # One letter less: this one is passed over; later ones are found one position earlier.
                missing = (missing & last) | same
                replaced = (replaced & now) | (same & ~now)
                same &= now
            agree = np.where(bound >= n, np.where(bound == n, same, agree), agree)
            replaced[m[query] != n] = 0
            found = (replaced & by_length[n][here]) | (missing & by_length.get(n - 1, nothing)[here])
            # The letter more may also be the last.
            found |= (more | same) & by_length.get(n + 1, nothing)[here]
            found &= ~agree
            hit = np.flatnonzero(found)
            bits = np.unpackbits(found[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, place = np.nonzero(bits)
            query, here = query[hit[row]], here[hit[row]]
            left.append(query)
            right.append(begin[shard[query]] + (here - first_lane[shard[query]]) * 64 + place)
    return np.concatenate(left), np.concatenate(right)


PARTS = "word string, many bigint, top_n bigint, top string"


def _by_length(rows: pa.Table) -> Iterator[pa.Table]:
    """Words of about the same length, so that one very long word does not widen all."""
    octave = np.log2(rows["m"].to_numpy()).astype(int)
    cuts = np.flatnonzero(np.r_[True, octave[1:] != octave[:-1], True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield rows.slice(a, b - a)


def _solve(rows: pa.Table) -> pa.RecordBatch:
    """Of whole shards, sorted by shard and word: each word's near ones there, and the best of them."""
    words = rows["word"].to_pylist()
    starts = np.zeros(len(words), bool)
    starts[:1] = True
    for name in KEY:
        column = rows[name].combine_chunks()
        starts[1:] |= np.array(pc.not_equal(column[1:], column[:-1]))
    shard = np.cumsum(starts) - 1
    n = rows["n"].to_numpy()
    i, j = near(words, shard, rows["m"].to_numpy(), rows["before"].to_numpy())
    # Words are in order within a shard, so of equally frequent ones the first is the smallest.
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
    many = np.diff(np.r_[first, len(i)])
    names = rows["word"].combine_chunks()
    columns = [names.take(pa.array(i[first])), pa.array(many, pa.int64()), pa.array(n[j[first]], pa.int64()), names.take(pa.array(j[first]))]
    return pa.RecordBatch.from_arrays(columns, ["word", "many", "top_n", "top"])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(pc.sum(b.column("m")).as_py() for b in held) < HELD_LETTERS:
            continue
        rows = pa.Table.from_batches(held)
        last, same = {name: rows[name][-1] for name in KEY}, None
        for name in KEY:
            equal = pc.equal(rows[name].combine_chunks(), last[name])
            same = equal if same is None else pc.and_(same, equal)
        same = np.array(same)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield from map(_solve, _by_length(rows.slice(0, cut)))
        held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield from map(_solve, _by_length(pa.Table.from_batches(held)))


def neighbours(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """``word``, ``many`` near words, and of these the most frequent one: ``top_n`` and ``top`` (ties: the smallest)."""
    rows = shards(words, shard)
    rows = rows.repartition(*KEY).sortWithinPartitions(*KEY, "word")
    parts = rows.mapInArrow(_search, PARTS)
    best = F.min(F.struct((-F.col("top_n")).alias("less"), F.col("top"))).alias("best")
    found = parts.groupBy("word").agg(F.sum("many").alias("many"), best)
    return found.select("word", "many", (-F.col("best.less")).alias("top_n"), F.col("best.top").alias("top"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``form`` to ``word`` and ``root``: the end of the chain of forms.

    Every round doubles what a word looks ahead. A form is at least twice as frequent as its word, so there
    are no rings, and chains and rounds are few.
    """
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = ahead.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        joined = ahead.join(after, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved"))
        joined = stored(joined, "roots")
        if joined.filter("moved").isEmpty():
            return joined.drop("moved")
        ahead = joined.drop("moved")


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, shard: int = SHARD) -> DataFrame:
    """A row per word: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    Two words are near if they differ by one inserted, deleted or replaced code point. ``form`` is the near
    word of largest ``n`` (ties: the smallest in code-point order) if that is at least twice the word's own, else null;
    ``root`` follows the forms to the last, which is the word itself if it has none. Repeated rows of ``docs`` count as
    often. No documents, and documents without long and frequent words, give no rows.
    """
    words = vocabulary(docs, shortest, least)
    found = stored(neighbours(words, shard), "near")
    rows = words.join(found, "word", "left")
    good = F.col("top_n") >= TIMES * F.col("n")
    rows = stored(rows.select(
        "word", "n", F.coalesce("many", F.lit(0)).alias("n_near"),
        F.when(good, F.col("top")).alias("form"), F.when(good, F.col("top_n")).alias("form_n"),
    ), "forms")
    roots = _roots(rows.filter("form IS NOT NULL"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
