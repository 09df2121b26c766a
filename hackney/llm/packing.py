"""Best-fit packing of documents into sequences, reduced by dominance first.

Only lengths matter for packing, and there are at most ``capacity`` of them, so the plan is made from
the number of pieces of each length: first all sets that dominate every alternative are fixed, as
many at a time as there are (reduction after Martello and Toth), then the remaining pieces go, in
descending length, to the fullest sequence that takes them. A step places a run of equal pieces in a
run of equal sequences; the plan is a few thousand steps for any number of documents. The pieces
find their step by their number among those of the same length, which is counted within blocks
and added up over blocks, without sorting all pieces of a length in one place.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import small, stored, texts_of
from hackney.llm.encoder import Encoder

CAPACITY = 1024
#: The id that ends a document.
END = 2
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, block bigint, number bigint"


@dataclass(frozen=True)
class Step:
    """Pieces ``first`` to ``first + count`` of a length: ``each`` at a time to sequences from ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int
    each: int


class _Plan:
    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = dict(counts)
        self.lengths = sorted(length for length, count in counts.items() if count)
        self.used = dict.fromkeys(self.lengths, 0)
        self.steps: list[Step] = []
        self.sequences = 0

    def put(self, length: int, count: int, sequence: int, offset: int, each: int = 1) -> None:
        self.steps.append(Step(length, self.used[length], count, sequence, offset, each))
        self.used[length] += count
        self.left[length] -= count
        if not self.left[length]:
            self.lengths.remove(length)

    def fix(self, members: list[int]) -> None:
        """As many sequences with exactly these pieces as there are pieces for."""
        need = {length: members.count(length) for length in members}
        many = min(self.left[length] // n for length, n in need.items())
        offset = 0
        for length, n in need.items():
            self.put(length, many * n, self.sequences, offset, n)
            offset += length * n
        self.sequences += many

    def available(self, length: int, taken: list[int]) -> bool:
        return self.left.get(length, 0) > taken.count(length)

    def largest(self, room: int, taken: list[int]) -> int | None:
        """The largest piece that fits, with ``taken`` set aside."""
        for i in range(bisect_left(self.lengths, room + 1) - 1, -1, -1):
            if self.available(self.lengths[i], taken):
                return self.lengths[i]
        return None

    def smallest(self, taken: list[int], many: int) -> list[int]:
        found: list[int] = []
        for length in self.lengths:
            found += [length] * min(many - len(found), self.left[length] - taken.count(length))
            if len(found) == many:
                break
        return found

    def dominating(self, length: int) -> list[int] | None:
        """A set with a piece of this length that dominates all others with it, or None.

        Set A dominates set B if the pieces of B can be shared out among those of A so that no share
        is larger than its piece; then some best packing has A as a sequence. Examined are sets of
        up to three pieces, as no more than two others fit beside ``length`` where one is returned.
        """
        taken, room = [length], self.capacity - length
        one = self.largest(room, taken)
        if one is None:
            return taken
        if one == room:
            return [length, one]
        least = self.smallest(taken, 3)
        if len(least) < 2 or sum(least[:2]) > room:
            return [length, one]
        if len(least) == 3 and sum(least) <= room:
            return None
        # At most two others fit. The largest piece dominates if it takes the place of any two.
        best = 0
        for i, a in enumerate(self.lengths):
            if a > room:
                break
            b = self.largest(min(room - a, a), [length, a]) if self.available(a, taken) else None
            best = max(best, a + b if b is not None else 0)
        if best <= one:
            return [length, one]
        # The largest piece with the largest beside it dominates if no other two are both larger than the latter.
        two = self.largest(room - one, [length, one])
        if two is not None:
            over = [x for x in self.lengths if x > two]
            pair: list[int] = []
            for x in over:
                pair += [x] * min(2 - len(pair), self.left[x] - taken.count(x))
                if len(pair) == 2:
                    break
            if len(pair) < 2 or sum(pair) > room:
                return [length, one, two]
        return None

    def reduce(self) -> None:
        """Fix dominating sets, from the largest piece down, until no length has one."""
        again = True
        while again:
            again = False
            for length in reversed(self.lengths.copy()):
                while self.left[length] and (members := self.dominating(length)):
                    self.fix(members)
                    again = True

    def best_fit(self) -> None:
        # Sequences with equal room: (room, first sequence, how many), sorted.
        open_: list[tuple[int, int, int]] = []
        for length in reversed(self.lengths.copy()):
            while self.left[length]:
                at = bisect_left(open_, (length, -1, -1))
                if at < len(open_):
                    room, sequence, many = open_.pop(at)
                    each = min(room // length, self.left[length])
                    n = min(many, self.left[length] // each)
                    self.put(length, n * each, sequence, self.capacity - room, each)
                    if n < many:
                        insort(open_, (room, sequence + n, many - n))
                    if room > each * length:
                        insort(open_, (room - each * length, sequence, n))
                    continue
                # As many as fit into a new sequence, which is the fullest that takes the next one.
                each = min(self.capacity // length, self.left[length])
                many = self.left[length] // each
                self.put(length, many * each, self.sequences, 0, each)
                if self.capacity > each * length:
                    insort(open_, (self.capacity - each * length, self.sequences, many))
                self.sequences += many


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Step]:
    """Where the pieces of each length go."""
    made = _Plan(counts, capacity)
    made.reduce()
    made.best_fit()
    return made.steps


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents: ids of ``tokenizer`` (a file's path) and one that ends the document.

    Documents longer than ``capacity`` are cut into pieces of that length, the first of which may be
    shorter. ``ids`` holds 32-bit integers, little-endian; ``number`` counts pieces of equal length
    within a ``block``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = Encoder(tokenizer), TaskContext.get().partitionId() << 32
        end = END.to_bytes(4, "little")
        for whole in batches:
            for batch in small(whole):
                owner, piece, start, ids = [], [], [], []
                for i, text in enumerate(texts_of(batch)):
                    coded = encoder.encode(text) + end
                    size = len(coded) // 4
                    at, n = 0, 0
                    while at < size:
                        stop = size - (size - at - 1) // capacity * capacity
                        owner.append(i)
                        piece.append(n)
                        start.append(at)
                        ids.append(coded[4 * at : 4 * stop])
                        at, n = stop, n + 1
                length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                number = np.empty(len(ids), np.int64)
                number[order] = np.arange(len(ids)) - np.searchsorted(ranked, ranked)
                columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(start, pa.int64()), pa.array(length), pa.array(ids, pa.binary())]
                columns += [pa.array(np.full(len(ids), block)), pa.array(number)]
                names = ["doc_id", "piece", "start", "length", "ids", "block", "number"]
                yield pa.RecordBatch.from_arrays(columns, names)
                block += 1

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Needs the ``length``, ``block`` and ``number`` of ``cut``, which go; other columns are kept.
    Sequences are filled from offset 0 without gaps.
    """
    spark = pieces.sparkSession
    counts = stored(pieces.groupBy("block", "length").agg(F.count("*").alias("many")), "piece-counts")
    # A row per length: ``capacity`` rows at most.
    totals = {r["length"]: r["many"] for r in counts.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    steps: dict[int, list[tuple[int, int, int, int]]] = {}
    for s in plan(totals, capacity):
        steps.setdefault(s.length, []).append((s.first, s.sequence, s.offset, s.each))
    # A row per length again; a few steps in each.
    table = spark.createDataFrame(
        list(steps.items()),
        "length bigint, steps array<struct<first: bigint, sequence: bigint, at: bigint, each: bigint>>",
    )
    # The running count of a length goes over tasks first, and then over the blocks of a task, so that no window
    # has more rows than there are tasks, or blocks in one.
    counts = counts.withColumn("task", F.shiftright("block", 32))
    tasks = counts.groupBy("length", "task").agg(F.sum("many").alias("many"))
    earlier = F.sum("many").over(Window.partitionBy("length").orderBy("task")) - F.col("many")
    tasks = tasks.select("length", "task", earlier.alias("earlier"))
    within = F.sum("many").over(Window.partitionBy("length", "task").orderBy("block")) - F.col("many")
    counts = counts.withColumn("within", within).join(tasks, ["length", "task"])
    counts = counts.select("block", "length", (F.col("earlier") + F.col("within")).alias("__before"))
    placed = pieces.join(counts, ["block", "length"]).join(F.broadcast(table), "length")
    placed = placed.withColumn("__rank", F.col("__before") + F.col("number"))
    placed = placed.withColumn("__step", F.expr("element_at(filter(steps, s -> s.first <= __rank), -1)"))
    nth = F.col("__rank") - F.col("__step.first")
    return placed.select(
        *(c for c in pieces.columns if c not in ("block", "number")),
        (F.col("__step.sequence") + F.floor(nth / F.col("__step.each"))).cast("bigint").alias("sequence_id"),
        (F.col("__step.at") + nth % F.col("__step.each") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of all documents, with their ids and places: the columns of ``cut`` and ``place``.

    A null or empty text is the id that ends a document; repeated rows are documents of their own,
    as are those without ``doc_id``; no documents make no sequences.
    """
    return place(stored(cut(docs, tokenizer, capacity), "pieces"), capacity)


def placements(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """As ``pack``, but with ``ids_crc32`` for the ids, which then need not move to be placed."""
    pieces = stored(cut(docs, tokenizer, capacity), "pieces")
    return place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids``, and the documents in them."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.expr("aggregate(parts, CAST('' AS BINARY), (a, p) -> concat(a, p.ids))")
    return rows.select("sequence_id", ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
