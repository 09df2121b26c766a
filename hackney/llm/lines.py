"""Lines that repeat across documents: sorted hashes, first occurrences, keep bitmaps.

The lines' hashes are partitioned by range and sorted by hash, document and position. One pass over
a partition sees each line's first document and reports what comes after it. The range key has the
document and position too, so a line that a third of all documents share spans many partitions;
what a partition's first and last hash need from its neighbours comes from one row per partition
and edge. The result is a compressed bitmap for each document that loses a line, not text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import NO_ID, SPACES, small, stored, texts_of

#: A key of fewer code points is never dropped.
SHORTEST = 10
LINES = "doc_id bigint, row bigint, position int, high bigint, low bigint"
MARKS = "doc_id bigint, row bigint, position int, high bigint, low bigint, edge boolean"


def key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _long_enough(line: bytes, shortest: int) -> bool:
    return len(line) >= shortest and (len(line) >= 4 * shortest or len(line.decode()) >= shortest)


def hashed(docs: DataFrame, shortest: int = SHORTEST, spared: str | None = None) -> DataFrame:
    """A row per line that may be dropped: its place and the 128 bits of its key's hash.

    ``row`` is a hash of the text: it tells rows with the same ``doc_id`` apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stays = re.compile(spared.encode()).search if spared else lambda line: None
        for whole in batches:
            for batch in small(whole):
                owner, place, digests = [], [], []
                for i, text in enumerate(texts_of(batch)):
                    for n, line in enumerate(text.split(b"\n")):
                        if len(line) >= shortest and _long_enough(k := key(line), shortest) and not stays(line):
                            owner.append(i)
                            place.append(n)
                            digests.append(xxhash.xxh3_128_digest(k))
                words = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = pa.array(owner, pa.int64())
                columns = [batch.column(0).take(at), batch.column(2).take(at), pa.array(place, pa.int32())]
                columns += [pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "position", "high", "low"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    return rows.mapInArrow(run, LINES)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition, the lines that are not in their first document.

    All lines of its first and its last hash are reported too, as ``edge``, since their first
    document may be in another partition. Held back are only rows of the hash that is still open.
    """
    first, held, open_hash = None, [], None

    def marked(rows: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
        flags = pa.array(np.full(rows.num_rows, edge))
        return pa.RecordBatch.from_arrays([*rows.columns, flags], names=[*rows.schema.names, "edge"])

    def decided() -> Iterator[pa.RecordBatch]:
        least = _ids(held[0])[0] if held else None
        for rows in held:
            yield marked(rows.filter(pa.array(_ids(rows) != least)), False)

    for batch in batches:
        if not batch.num_rows:
            continue
        high, low = (batch.column(c).to_numpy() for c in ("high", "low"))
        begins = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        hashes = [(int(high[b]), int(low[b])) for b in (begins[0], begins[-1])]
        ends = np.r_[begins[1:], batch.num_rows]
        first = first or hashes[0]
        done = 0
        if hashes[0] == first:
            yield marked(batch.slice(0, ends[0]), True)
            done = 1
        elif hashes[0] == open_hash:
            held.append(batch.slice(0, ends[0]))
            done = 1
        if done == len(begins):
            continue
        yield from decided()
        lo, hi = (begins[done], begins[-1])
        if hi > lo:
            inner, sizes = batch.slice(lo, hi - lo), np.diff(begins[done:])
            ids = _ids(inner)
            later = ids != np.repeat(ids[begins[done:-1] - lo], sizes)
            yield marked(inner.filter(pa.array(later)), False)
        held, open_hash = [batch.slice(hi)], hashes[1]
    for rows in held:
        yield marked(rows, True)


def _ids(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column("doc_id").fill_null(NO_ID).to_numpy()


@F.pandas_udf(T.BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    def pack(dropped: np.ndarray) -> bytes:
        keep = np.ones(max(dropped) // 8 * 8 + 8, bool)  # whole bytes; what follows the last line stays
        keep[dropped] = False
        return zlib.compress(np.packbits(keep, bitorder="little").tobytes())

    return positions.map(pack)


def keep_bitmaps(docs: DataFrame, shortest: int = SHORTEST, spared: str | None = None) -> DataFrame:
    """``doc_id``, ``row`` and ``keep`` of each document that loses a line.

    ``keep`` is a zlib-compressed bitmap with a bit per line up to the last one that goes; later
    lines stay. A line goes if its key, the line without white space at its ends and with A-Z in
    lower case, has at least ``shortest`` code points and a smaller ``doc_id`` holds it. All its
    lines in the smallest one stay. A null ``doc_id`` counts as the smallest; rows with the same
    ``doc_id`` are one document, in which each text has its own bitmap (``row``). Lines in which the
    expression ``spared`` matches stay everywhere.
    """
    lines = stored(hashed(docs, shortest, spared), "lines")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["high", "low", "doc_id", "row", "position"]
    dealt = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    marks = stored(dealt.mapInArrow(_stream, MARKS), "marks")
    known = F.coalesce("doc_id", F.lit(NO_ID))
    # Two hashes per partition at most.
    edges = marks.filter("edge").groupBy("high", "low").agg(F.min(known).alias("least"))
    gone = marks.join(F.broadcast(edges), ["high", "low"], "left").filter(~F.col("edge") | (known > F.col("least")))
    places = gone.groupBy("doc_id", "row").agg(F.collect_set("position").alias("places"))
    return places.select("doc_id", "row", _bitmap("places").alias("keep"))


@F.pandas_udf(T.StructType().add("text", "string").add("n_dropped", "long"))
def _apply(text: pd.Series, keep: pd.Series) -> pd.DataFrame:
    kept, dropped = [], []
    for line, packed in zip(text, keep):
        if packed is None:
            kept.append(None)
            dropped.append(0)
            continue
        lines = line.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")[: len(lines)]
        stay = [x for x, bit in zip(lines, bits) if bit] + lines[len(bits) :]
        kept.append("\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"text": kept, "n_dropped": dropped})


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less the lines that go, and ``n_lines`` (before) and ``n_dropped`` added.

    Only texts that lose a line go through Python. A null or empty text is one empty line, and a
    null text stays null.
    """
    rows = docs.withColumn("__row", F.xxhash64("text"))
    bits = bitmaps.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("keep").alias("__keep"))
    same = rows["doc_id"].eqNullSafe(bits["__id"]) & (rows["__row"] == bits["__row"])
    rows = rows.join(bits, same, "left").drop("__id", "__row")
    rows = rows.withColumn("__new", _apply(F.when(F.col("__keep").isNotNull(), F.col("text")), "__keep"))
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(1)).cast("bigint")
    return rows.select(
        *(F.coalesce("__new.text", "text").alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.when(F.col("text").isNull(), F.lit(1)).otherwise(lines).cast("bigint").alias("n_lines"),
        F.col("__new.n_dropped").alias("n_dropped"),
    )


def dedupe_lines(docs: DataFrame, shortest: int = SHORTEST, spared: str | None = None) -> DataFrame:
    """``docs`` without lines that an earlier document holds; see ``keep_bitmaps`` and ``apply_bitmaps``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, shortest, spared))
