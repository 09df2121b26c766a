"""Near duplicates by SimHash: BK-trees over shards of fingerprints.

Texts become 64-bit fingerprints. Two fingerprints that differ in ``radius`` bits agree in all but
``radius`` of their bands of bits, so the fingerprints that share the values of such a choice of bands form a shard,
and every link lies within a shard. The more fingerprints, the more bands, so that shards stay small. A shard is a BK-tree, its children keyed by their distance to the parent;
a search follows only the edges within the radius. A shard above ``SHARD`` fingerprints becomes
several trees, each sent to all blocks of the shard's fingerprints that search it. Trees travel with
the shuffle by shard, not to every executor, as all of them together grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import NO_ID, small, stored, texts_of
from hackney.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints in a tree at most, about.
SHARD = 2048
#: Pairs of a query and a node that are looked at together.
FRONT = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if over half of the shingles' hashes have it; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest, total, ones = xxhash.xxh64_intdigest, 0, np.zeros(64, np.int64)
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``row``, a hash of the text, and ``fp``, the fingerprint as a signed BIGINT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small(whole):
                found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64)
                columns = [batch.column(0), batch.column(1), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return rows.mapInArrow(run, "doc_id bigint, row bigint, fp bigint")


def plant(values: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of distinct values, one per shard (numbers from 0, ascending).

    Returns the slot of each edge (parent * 65 + distance), sorted, its child, and the shards' roots.
    All values step down together: the first to come to a free slot becomes the child there, as if
    they had been inserted one by one.
    """
    _, roots = np.unique(shard, return_index=True)
    here = roots[shard]
    moving = np.flatnonzero(here != np.arange(len(values)))
    here, slots, children = here[moving], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(moving):
        slot = here * 65 + np.bitwise_count(values[moving] ^ values[here])
        new, first, back = np.unique(slot, return_index=True, return_inverse=True)
        child = moving[first]
        slots.append(new)
        children.append(child)
        rest = np.ones(len(moving), bool)
        rest[first] = False
        here, moving = child[back][rest], moving[rest]
    slots, children = np.concatenate(slots), np.concatenate(children)
    order = np.argsort(slots, kind="stable")
    return slots[order], children[order], roots


def search(
    tree: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray, wanted: np.ndarray, shard: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (position in ``wanted``, node) within the radius, in portions."""
    slots, children, roots = tree
    todo = [(np.arange(len(wanted)), roots[shard])]
    while todo:
        query, node = todo.pop()
        if len(query) > FRONT:
            half = len(query) // 2
            todo += [(query[:half], node[:half]), (query[half:], node[half:])]
            continue
        apart = np.bitwise_count(wanted[query] ^ values[node]).astype(np.int64)
        near = apart <= radius
        if near.any():
            yield query[near], node[near]
        low = np.searchsorted(slots, node * 65 + np.maximum(apart - radius, 0))
        many = np.searchsorted(slots, node * 65 + np.minimum(apart + radius, 64), "right") - low
        if many.any():
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            todo.append((np.repeat(query, many), children[np.repeat(low, many) + step]))


def join_roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of each a and b in ``parent``, which is kept flat."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _links(radius: int):
    """For rows sorted by shard: links that connect what is near, as few as possible."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        value = rows["fp"].to_numpy().view(np.uint64)
        keys = np.stack([rows[c].to_numpy() for c in ("shard", "i", "j")], 1)
        group = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)]) if len(keys) else np.zeros(0, np.int64)
        block = rows["block"].to_numpy()
        nodes, queries = np.flatnonzero(block == keys[:, 1]), np.flatnonzero(block == keys[:, 2])
        # Groups without nodes have nothing to search.
        present, inner = np.unique(group[nodes], return_inverse=True)
        queries = queries[np.isin(group[queries], present)]
        parent = np.arange(len(value))
        if len(nodes):
            tree = plant(value[nodes], inner)
            places = np.searchsorted(present, group[queries])
            for query, node in search(tree, value[nodes], value[queries], places, radius):
                join_roots(parent, queries[query], nodes[node])
        far = np.flatnonzero(parent != np.arange(len(parent)))
        signed = value.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[far]), pa.array(signed[parent[far]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 50_000:
                continue
            rows = pa.Table.from_batches(held)
            last = [rows[c].to_numpy() for c in ("shard", "i", "j")]
            same = np.logical_and.reduce([c == c[-1] for c in last])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield solve(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def bands_for(many: int, radius: int = RADIUS, shard: int = SHARD) -> int:
    """In how many bands to cut fingerprints, so that ``many`` random ones make shards of ``shard`` at most.

    A link leaves all bands but ``radius`` as they are, so a key is any choice of the others. More bands make more
    and longer keys: with a radius of 3, four bands 4 keys of 16 bits, six bands 20 keys of 32.
    """
    bands = radius + 1
    while bands < 2 * radius + 2 and many >> (64 * (bands - radius) // bands) > shard // 2:
        bands += 1
    return bands


def _keys(bands: int, radius: int) -> Column:
    """The shards of a fingerprint: a hash per choice of bands."""
    edges = [64 * i // bands for i in range(bands + 1)]
    value = [
        F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges, edges[1:])
    ]
    chosen = combinations(range(bands), bands - radius)
    return F.array(*(F.xxhash64(F.lit(n), *(value[i] for i in some)) for n, some in enumerate(chosen)))


def dealt(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD, bands: int | None = None) -> DataFrame:
    """The fingerprints ``fp`` of each shard, once per pair (i, j) of its blocks that their own ``block`` is in."""
    every = stored(prints.select("fp").distinct(), "distinct")
    bands = bands or bands_for(every.count(), radius, shard)
    rows = every.select("fp", F.explode(_keys(bands, radius)).alias("shard"))
    sizes = rows.groupBy("shard").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / shard).cast("int")
    rows = rows.join(sizes, "shard").select("shard", "fp", blocks.alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.select("shard", "fp", "block", other.alias("other")).select(
        "shard", "fp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD, bands: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints ``fp`` within the radius, and no others.

    The number of ``bands`` follows the number of fingerprints unless it is given; the links do not depend on it.
    """
    rows = dealt(prints, radius, shard, bands)
    rows = rows.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
    return rows.mapInArrow(_links(radius), "a bigint, b bigint")


def groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Each distinct ``fp`` and ``root``, the smallest one that it reaches over links of ``radius`` bits."""
    roots = components(links(prints, radius)).select(F.col("node").alias("fp"), "root")
    every = prints.select("fp").distinct().join(roots, "fp", "left")
    return stored(every.select("fp", F.coalesce("root", "fp").alias("root")), "groups")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id``.

    The component is named by the smallest ``doc_id`` that can be reached over links of ``radius``
    bits at most, itself included. Null and empty texts have fingerprint 0, which links as any
    other. A null ``doc_id`` keeps its row but names no component unless all of it are null.
    Repeated rows come back as often as they went in.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    found = groups(prints, radius)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(found, "fp")
    names = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.join(names, "root").select("fp", "component_id")
    # A fingerprint with very many copies is a skewed join, which Spark splits.
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of every group of near duplicates the row of ``docs`` that has the smallest ``doc_id``.

    Of rows with the same ``doc_id`` the one whose text has the smallest hash stays, and of equal rows
    one. A row without ``doc_id`` stays only if its whole group has none.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    least = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"))
    chosen = least.join(groups(prints, radius), "fp").groupBy("root").agg(F.min("least").alias("least"))
    number = lambda c: F.coalesce(c, F.lit(NO_ID))
    chosen = chosen.select(number(F.col("least.doc_id")).alias("__id"), F.col("least.row").alias("__row"))
    rows = docs.withColumns({"__id": number(F.col("doc_id")), "__row": F.xxhash64("text")})
    # The rows are already together by these columns when equal ones are dropped.
    return rows.join(chosen, ["__id", "__row"], "left_semi").dropDuplicates(["__id", "__row"]).select(*docs.columns)
