"""Byte-level BPE: words found by scans over code point classes, pairs merged once per distinct word.

The pattern that cuts texts into words is an automaton of eight states over the classes of code points,
with what must be looked ahead for put into the class. A character then is a function from state to
state; such functions compose associatively and there are few of them, so the states at all places come
from one scan over compositions in a table, block by block, for all texts of a batch together. No regular
expression is used. Words are merged by rank, and those already seen are taken from a cache.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hackney.llm.common import small, texts_of

#: Code points looked at together.
WINDOW = 1 << 20
#: Words kept by a task; beyond that it starts afresh.
KEPT = 600_000
#: Bytes from which a word's pairs wait in a heap.
LONG = 256
BLOCK = 128

# Unicode's White_Space.
_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, OTHER, SHORT, LONGER, WITHIN, BEFORE, LAST = range(8)
#: States: before a new word; in letters, numbers, others, white space; after a space that joins what follows;
#: with one or two letters of a contraction to come.
FRESH, LETTERS, NUMBERS, OTHERS, SPACES, JOINING, ONE, TWO = range(8)


def _step(state: int, symbol: int) -> tuple[bool, int]:
    """Whether a word starts at the character, and the state after it."""
    if symbol == LETTER:
        if state in (ONE, TWO):
            return False, FRESH if state == ONE else ONE
        return state not in (LETTERS, JOINING), LETTERS
    if symbol == NUMBER:
        return state not in (NUMBERS, JOINING), NUMBERS
    if symbol == OTHER or state in (OTHERS, JOINING) and symbol in (SHORT, LONGER):
        return state not in (OTHERS, JOINING), OTHERS
    if symbol in (SHORT, LONGER):  # an apostrophe where a word starts, with s, t, m, d or re, ve, ll behind it
        return True, ONE if symbol == SHORT else TWO
    if symbol == WITHIN:  # white space before white space or the end
        return state != SPACES, SPACES
    return True, JOINING if symbol == BEFORE else FRESH  # the last white space before something else


@cache
def _tables() -> tuple[np.ndarray, ...]:
    """Class of each code point; functions by symbol, their compositions, their values; starts of words.

    Symbols from 8 on are those at the start of a text, where the state before does not count.
    """
    kind = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            kind[c] = LETTER if major == "L" else NUMBER
    kind[_SPACE] = WITHIN
    steps = [[_step(s if x < 8 else FRESH, x % 8) for s in range(8)] for x in range(16)]
    found = [tuple(range(8)), *(tuple(after for _, after in step) for step in steps)]
    found = list(dict.fromkeys(found))
    for f in found:  # grows while it is read, until closed under composition
        for step in steps:
            g = tuple(step[s][1] for s in f)
            if g not in found:
                found.append(g)
    number = {f: i for i, f in enumerate(found)}
    by_symbol = np.array([number[tuple(after for _, after in step)] for step in steps], np.uint8)
    after = np.array([[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8)
    starts = np.array([[step[s][0] for step in steps] for s in range(8)], bool)
    return kind, by_symbol, after, np.array(found, np.uint8), starts


def scan(functions: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """For each place the composition of all functions up to and with it (inclusive prefix)."""
    n = len(functions)
    if n <= BLOCK:
        out = functions.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)  # function 0 changes nothing
    padded[:n] = functions
    rows = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    flat, width = compose.ravel(), np.intp(len(compose))
    for i in range(1, BLOCK):
        rows[i] = flat[rows[i - 1] * width + rows[i]]
    before = np.r_[np.uint8(0), scan(rows[-1].copy(), compose)[:-1]]
    rows = flat[before * width + rows]
    return rows.T.ravel()[:n]


def starts_of_words(points: np.ndarray, starts_of_texts: np.ndarray) -> np.ndarray:
    """Where words start among the code points of texts that stand one behind the other."""
    kind, by_symbol, compose, value, starts = _tables()
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[starts_of_texts] = True
    first[n] = True
    symbol = kind[points]
    space = symbol == WITHIN
    follows = np.r_[~space[1:], False] & ~first[1:]
    last = np.flatnonzero(space & follows)
    symbol[last] = np.where(points[last] == 32, BEFORE, LAST)
    quote = np.flatnonzero(points == 39)
    if len(quote):
        ends = np.r_[first, True, True]
        ahead = np.r_[points, 0, 0]
        one = np.where(ends[quote + 1], 0, ahead[quote + 1])
        two = np.where(ends[quote + 1] | ends[quote + 2], 0, ahead[quote + 2])
        letters = {c: ord(c) for c in "stmdrevl"}
        symbol[quote[np.isin(one, [letters[c] for c in "stmd"])]] = SHORT
        pairs = [(letters[a], letters[b]) for a, b in ("re", "ve", "ll")]
        symbol[quote[np.logical_or.reduce([(one == a) & (two == b) for a, b in pairs])]] = LONGER
    symbol[first[:n]] += 8
    state = value[scan(by_symbol[symbol], compose), FRESH]
    return np.flatnonzero(starts[np.r_[np.uint8(FRESH), state[:-1]], symbol]) if n else np.zeros(0, np.int64)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The word's ids: of all neighbours the pair with the lowest rank is joined first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) >= LONG:
        return _merge_long(word, ranks)
    none, cuts = len(ranks), list(range(len(word) + 1))
    pairs = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) < none:
        k = pairs.index(low)
        del cuts[k + 1], pairs[k]
        if k < len(pairs):
            pairs[k] = ranks.get(word[cuts[k] : cuts[k + 2]], none)
        if k:
            pairs[k - 1] = ranks.get(word[cuts[k - 1] : cuts[k + 1]], none)
    return [ranks[word[a:b]] for a, b in pairwise(cuts)]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``; pairs wait in a heap, and those that have changed are passed over."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    waiting = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, stop = heapq.heappop(waiting)
        middle = end[i]
        if middle < 0 or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(waiting, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(word[j:stop])) is not None:
            heapq.heappush(waiting, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    """The file's byte strings and their ranks, which are the ids."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Coder:
    def __init__(self, path: str, kept: int = KEPT) -> None:
        self._ranks, self._kept, self._known = read_ranks(path), kept, {}

    def _ids(self, words: list[bytes]) -> list[bytes]:
        if len(self._known) > self._kept:
            self._known = {}
        known = self._known
        ids = list(map(known.get, words))
        if None in ids:
            ranks = self._ranks
            for i, word in enumerate(words):
                if ids[i] is None:
                    if (coded := known.get(word)) is None:
                        coded = known[word] = np.array(merge(word, ranks), "<u4").tobytes()
                    ids[i] = coded
        return ids

    def _window(self, raw: bytes, sizes: np.ndarray, points: np.ndarray, firsts: np.ndarray) -> tuple:
        starts = starts_of_words(points, firsts)
        at = np.r_[0, np.cumsum(sizes, dtype=np.int64)][np.r_[starts, len(points)]]
        places = at.tolist()
        return starts, at, self._ids([raw[a:b] for a, b in pairwise(places)])

    def _long(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """A text that fills windows of its own. A window ends where a word starts; its last words come again."""
        chars, at, byte, window = text.decode(), 0, 0, WINDOW
        out, offsets = [], []
        while at < len(chars):
            part = chars[at : at + window]
            raw = part.encode()
            points, sizes = _points(part)
            starts, places, ids = self._window(raw, sizes, points, np.zeros(1, np.int64))
            whole = len(starts)
            if at + window < len(chars):
                # What a word is depends on two characters behind it; white space on the end of its run.
                whole = int(np.searchsorted(starts, len(points) - 3, "right")) - 1
                if whole < 1:
                    window *= 2
                    continue
            out += ids[:whole]
            offsets.append(places[:whole] + byte)
            at += int(starts[whole]) if whole < len(starts) else len(points)
            byte += int(places[whole])
            window = WINDOW
        return b"".join(out), np.concatenate(offsets)

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
        """For each text its ids as 32-bit integers, little-endian, and the byte offset of each word."""
        if any(len(t) > WINDOW for t in texts):
            return [self._long(t) if len(t) > WINDOW else self.encode([t])[0] for t in texts]
        raw = b"".join(texts)
        points, sizes = _points(raw.decode())
        ends = np.cumsum([0, *map(len, texts)])
        starts_in_bytes = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        firsts = np.searchsorted(starts_in_bytes, ends[:-1])
        filled = firsts[np.diff(ends) > 0]
        _, at, ids = self._window(raw, sizes, points, filled)
        cut = np.searchsorted(at, ends)
        return [
            (b"".join(ids[a:b]), at[a:b] - ends[i]) for i, (a, b) in enumerate(pairwise(cut.tolist()))
        ]


def _points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and the bytes that each takes in UTF-8."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = np.ones(len(points), np.int8)
    for limit in (0x80, 0x800, 0x10000):
        sizes += points >= limit
    return points, sizes


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (32-bit, little-endian) and ``offsets``, the byte offset of each word (the same).

    ``path`` is a file of ranks. Null and empty texts have no ids. A row in, a row out: repeated rows
    come back as often, and ``doc_id`` may be null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        for whole in batches:
            for batch in small(whole, 256):
                coded = coder.encode(list(texts_of(batch)))
                ids = pa.array([ids for ids, _ in coded], pa.binary())
                offsets = pa.array([at.astype("<u4").tobytes() for _, at in coded], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, offsets], ["doc_id", "ids", "offsets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids binary, offsets binary")


class Decoder:
    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._sizes = np.fromiter(map(len, self._bytes), np.int64)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def words(self, ids: bytes, offsets: bytes, first: int, last: int) -> bytes:
        """The text of words ``first`` to ``last`` (exclusive), from the ids they have alone."""
        numbers = np.frombuffer(ids, "<u4")
        at = np.r_[0, np.cumsum(self._sizes[numbers])]
        bounds = np.r_[np.frombuffer(offsets, "<u4"), at[-1]]
        a, b = np.searchsorted(at, bounds[[first, last]])
        return self.decode(numbers[a:b].tobytes())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``bytes`` that they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for whole in batches:
            for batch in small(whole):
                found = [decoder.decode(v.as_py() or b"") for v in batch.column(1)]
                columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, bytes binary")
