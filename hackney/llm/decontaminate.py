"""Benchmark decontamination: every suffix of the benchmark is searched in suffix arrays of the training text.

A task turns some megabytes of documents into a shard: the words that the benchmark knows, as numbers, in runs
that are long enough to hold a window, and the suffix array over them. All suffixes of the benchmark's items
are searched in it together, word by word: each keeps the interval of the array whose suffixes agree with it so
far, and two binary searches narrow it by the next word. An interval that is left after a window's words gives all
places where the window occurs; the last one that is left, the longest verbatim match.

Only the benchmark travels to the tasks, in blocks of bounded size; documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import stored, texts_of

#: Words of a window. An item of fewer, but not none, is one window.
WINDOW = 10
#: Bytes of text in a suffix array, about; a longer text has one of its own.
SHARD = 1 << 22
#: Words of the benchmark that go to the tasks at once, about; a longer item goes alone.
BLOCK = 1 << 20
#: Upper case to lower case, and everything but digits, letters and what is beyond ASCII to a space.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b in range(48, 58) or b in range(97, 123) or b > 127 else 32 for b in range(256)
)

FOUND = (
    "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<first: bigint, after: bigint>>,"
    " longest: struct<words: bigint, first: bigint, item: string>>"
)
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
_LONGEST = pa.struct([("words", pa.int64()), ("first", pa.int64()), ("item", pa.string())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Suffixes:
    """Items as lines of numbered words, and the suffixes that hold a window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        """``items``: names, and texts in UTF-8."""
        self.names = sorted({name for name, _ in items})
        rank = {name: i for i, name in enumerate(self.names)}
        self.numbers: dict[bytes, int] = {}
        line, starts, owners, sizes = [], [], [], []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            size = min(window, len(words))
            many = len(words) - size + 1
            starts.append(np.arange(many) + len(line))
            owners.append(np.full(many, rank[name]))
            sizes.append(np.full(many, size))
            line += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            line.append(0)
        none = [np.zeros(0, np.int64)]
        self.line = np.array(line, np.int32)
        self.starts, self.owners, self.sizes = (np.concatenate(none + x) for x in (starts, owners, sizes))
        ends = np.flatnonzero(self.line == 0)
        self.deepest = int(np.diff(np.r_[-1, ends]).max(initial=1)) - 1
        self.least = int(self.sizes.min(initial=window))


def suffix_array(line: np.ndarray, depth: int) -> np.ndarray:
    """The places of ``line`` in the order of their first ``depth`` words at least, by doubling."""
    order = np.argsort(line, kind="stable")
    rank = np.empty(len(line), np.int64)
    key, k = line.astype(np.int64), 1
    while True:
        here = key[order]
        new = np.r_[False, here[1:] != here[:-1]]
        rank[order] = np.cumsum(new)
        if k >= depth or rank[order[-1]] == len(line) - 1:
            return order
        after = np.zeros(len(line), np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (len(line) + 1) + after
        order = np.argsort(key, kind="stable")
        k *= 2


def _bound(line, order, depth, word, lo, hi, right):
    """In each interval, whose suffixes agree in ``depth`` words, the first place whose next word is not before ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = (lo + hi) >> 1
        there = line[order[np.where(open_, middle, 0)] + np.where(open_, depth, 0)]
        before = open_ & ((there <= word) if right else (there < word))
        lo = np.where(before, middle + 1, lo)
        hi = np.where(open_ & ~before, middle, hi)
    return lo


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some intervals, and which interval each is of."""
    size = hi - lo
    owner = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[owner], owner


class Matches:
    """What a shard's suffix array holds of the benchmark."""

    def __init__(self, line: np.ndarray, tests: Suffixes) -> None:
        order = suffix_array(line, tests.deepest)
        #: Words of the longest match that starts at each place, and the suffix that matches there.
        self.reach, self.source = np.zeros(len(line), np.int64), np.zeros(len(line), np.int64)
        #: Words of the longest window that starts at each place.
        self.window = np.zeros(len(line), np.int64)
        self._places, self._items = [], []
        alive = np.arange(len(tests.starts))
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), len(line))
        for depth in range(tests.deepest):
            word = tests.line[tests.starts[alive] + depth]
            first = _bound(line, order, depth, word, lo, hi, right=False)
            hi = _bound(line, order, depth, word, first, hi, right=True)
            left = (word > 0) & (first < hi)
            alive, lo, hi = alive[left], first[left], hi[left]
            if not len(alive):
                break
            if depth + 1 < tests.least:
                continue
            # Suffixes that agree so far share their interval, and others' intervals are apart.
            _, one, group = np.unique(lo, return_index=True, return_inverse=True)
            places, owner = _spread(lo[one], hi[one])
            places = order[places]
            self.reach[places], self.source[places] = depth + 1, alive[one][owner]
            ends = tests.sizes[alive] == depth + 1
            if ends.any():
                whole = np.zeros(len(one), bool)
                whole[group[ends]] = True
                inside = whole[owner]
                self.window[places[inside]] = depth + 1
                self._record(places[inside], owner[inside], group[ends], tests.owners[alive[ends]])
        self.reach[self.window == 0] = 0

    def _record(self, places: np.ndarray, owner: np.ndarray, group: np.ndarray, item: np.ndarray) -> None:
        pairs = np.unique(np.stack([group, item], 1), axis=0)
        self._places.append((places, owner))
        self._items.append(pairs)

    def items(self, doc: np.ndarray) -> np.ndarray:
        """Pairs (document, item) without repetition; ``doc`` gives the document of each place."""
        out = [np.zeros((0, 2), np.int64)]
        for (places, owner), pairs in zip(self._places, self._items):
            held = np.unique(np.stack([owner, doc[places]], 1), axis=0)
            low = np.searchsorted(pairs[:, 0], held[:, 0])
            high = np.searchsorted(pairs[:, 0], held[:, 0], "right")
            at, of = _spread(low, high)
            out.append(np.stack([held[of, 1], pairs[at, 1]], 1))
        return np.unique(np.concatenate(out), axis=0)


def search(texts: list[bytes], tests: Suffixes) -> list[tuple[int, list[tuple[int, int]], list[str], tuple | None]]:
    """Of each text the number of words, the spans of words that are hit, the items, and the longest match."""
    words, sizes = [], []
    for text in texts:
        mine = words_of(text)
        words += mine
        sizes.append(len(mine))
    sizes = np.array(sizes, np.int64)
    known = np.fromiter(map(tests.numbers.get, words, repeat(0)), np.int32, len(words))
    # Every text ends with a zero, as does every run of known words.
    doc = np.repeat(np.arange(len(texts)), sizes + 1)
    begin = np.cumsum(sizes + 1) - sizes - 1
    line = np.zeros(len(words) + len(texts), np.int32)
    line[np.arange(len(words)) + np.repeat(np.arange(len(texts)), sizes)] = known
    edges = np.flatnonzero(np.diff(np.r_[0, line > 0, 0]))
    first, after = edges[::2], edges[1::2]
    long_enough = after - first >= tests.least
    out = [(int(n), [], [], None) for n in sizes]
    if not len(tests.starts) or not long_enough.any():
        return out
    place, _ = _spread(first[long_enough], after[long_enough] + 1)
    found = Matches(line[place], tests)
    at = np.flatnonzero(found.window)
    # Words under a window: as many starts as ends are open. Places of a run are consecutive in both numberings.
    change = np.zeros(len(line) + 1, np.int64)
    np.add.at(change, place[at], 1)
    np.add.at(change, place[at] + found.window[at], -1)
    edges = np.flatnonzero(np.diff(np.r_[0, np.cumsum(change) > 0, 0]))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out[doc[a]][1].append((a - int(begin[doc[a]]), b - int(begin[doc[a]])))
    for d, item in found.items(doc[place]).tolist():
        out[d][2].append(tests.names[item])
    # The longest match of each document, the first of equal ones.
    best = at[np.lexsort((at, -found.reach[at], doc[place[at]]))]
    best = best[np.r_[True, np.diff(doc[place[best]]) > 0]] if len(best) else best
    for p in best.tolist():
        d = doc[place[p]]
        n, spans, items, _ = out[d]
        item = tests.names[tests.owners[found.source[p]]]
        out[d] = (n, spans, items, (int(found.reach[p]), int(place[p] - begin[d]), item))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of a shard's texts, one shard at a time."""
    start, size, held = 0, 0, []
    for i, one in enumerate(texts_of(batch, text)):
        if held and size + len(one) > SHARD:
            yield batch.slice(start, i - start), held
            start, size, held = i, 0, []
        held.append(one)
        size += len(one)
    if held:
        yield batch.slice(start), held


def _search(items: list[tuple[str, bytes]], window: int, text: str, keep: list[str], again: bool):
    """Search documents for one block of items; with ``again`` what other blocks have found is added to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Suffixes(items, window)
        for whole in batches:
            for batch, texts in _slices(whole, text):
                found = search(texts, tests)
                if again:
                    for i, old in enumerate(batch.column(batch.schema.get_field_index("found")).to_pylist()):
                        n, spans, names, longest = found[i]
                        spans = _merged([*spans, *((s["first"], s["after"]) for s in old["spans"])])
                        other = old["longest"] and tuple(old["longest"].values())
                        longest = max((x for x in (longest, other) if x), key=lambda x: (x[0], -x[1]), default=None)
                        found[i] = (n, spans, sorted({*names, *old["items"]}), longest)
                fields = [
                    pa.array([n for n, *_ in found], pa.int64()),
                    pa.array([sum(b - a for a, b in spans) for _, spans, *_ in found], pa.int64()),
                    pa.array([names for _, _, names, _ in found], pa.list_(pa.string())),
                    pa.array([[{"first": a, "after": b} for a, b in spans] for _, spans, *_ in found], _SPANS),
                    pa.array([x and dict(zip(("words", "first", "item"), x)) for *_, x in found], _LONGEST),
                ]
                struct = pa.StructArray.from_arrays(fields, ["n_words", "n_hit", "items", "spans", "longest"])
                columns = [batch.column(batch.schema.get_field_index(name)) for name in keep]
                yield pa.RecordBatch.from_arrays([*columns, struct], [*keep, "found"])

    return run


def _searched(docs: DataFrame, benchmark: DataFrame, window: int, keep: list[str], block: int) -> DataFrame:
    """The columns ``keep`` of ``docs`` as c0, c1 and so on, and ``found``."""
    names = {name: f"c{i}" for i, name in enumerate(dict.fromkeys([*keep, "text"]))}
    rows = docs.select(*(F.col(f"`{name}`").alias(new) for name, new in names.items()))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.distinct()
    # A word has a byte, and there is one between two.
    blocks = max(1, -(-(items.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0) // block))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(int(blocks))))
    for i in range(int(blocks)):
        some = [(r["item"], r["text"].encode()) for r in items.filter(F.col("block") == i).collect()]
        last = i == blocks - 1
        kept = [names[name] for name in (keep if last else names)]
        schema = T.StructType([f for f in rows.schema if f.name in kept] + [T.StructField("found", T._parse_datatype_string(FOUND))])
        rows = rows.mapInArrow(_search(some, window, names["text"], kept, again=i > 0), schema)
        rows = rows if last else stored(rows, "searched")
    return rows


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``longest``.

    Words compare in lower case (A-Z), without punctuation. A word is hit if it lies in an occurrence of
    ``window`` consecutive words of an item, or of a whole item that has fewer. ``items`` are those
    with such a window in the document, as text and sorted; ``spans`` are the runs of hit words; ``longest`` is,
    of the verbatim matches that start with a window, the longest: its words, the first of them, and its item.

    A null or empty text has no words, and an item without words no window. ``doc_id`` may be null,
    repeated rows come back as often, a null ``item_id`` is the item ''. Without items nothing is hit.
    """
    return _searched(docs, benchmark, window, ["doc_id"], block).select(F.col("c0").alias("doc_id"), "found.*")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without those that hold a window of the benchmark; see ``find``."""
    rows = _searched(docs, benchmark, window, docs.columns, block).filter("found.n_hit = 0")
    return rows.select(*(F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)))
