"""Whitening of embeddings by spectral divide and conquer.

Entries become integers, so that sums over all vectors are exact whatever their order. Spark adds up the sums per
dimension, and then the products of what is left when the nearest integers of the means are taken off; both come
as a number per dimension or pair of them. Of the covariance, a matrix of the dimension's size, polar
decompositions of shifted blocks give the projectors onto the eigenvalues above and below the shift: each
splits the block in two, until blocks are single components. Every task then projects its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import stored

#: Of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components at most.
COMPONENTS = 32
#: An eigenvalue below this share of the largest is that of no variance.
FLAT = 1e-12
#: Entries beyond are taken as this large; 64-bit integers end there.
LIMIT = 2.0**52
EPS = np.finfo(np.float64).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by dynamically weighted Halley steps (QDWH).

    ``low`` bounds the least singular value from below and says how far each step may stretch it; the first
    steps go by QR, which bears singular values near 0, the later ones by Cholesky.
    """
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    try:
        low = 0.9 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(n))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, EPS / 4), 1.0)
    eye = np.eye(n)
    for _ in range(60):
        if abs(1 - low) < 10 * EPS:
            low = 1.0
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved < np.cbrt(4 * EPS) and low > 1 - 1e-8:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if one is empty."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < n:
        return None
    # A random start has a part in every direction of the subspace; one step of subspace iteration is enough.
    start = projector @ np.random.default_rng(n).standard_normal((n, rank))
    upper, _ = np.linalg.qr(projector @ np.linalg.qr(start)[0])
    whole, _ = np.linalg.qr(np.hstack([upper, (np.eye(n) - projector) @ np.random.default_rng(n + 1).standard_normal((n, n - rank))]))
    return whole[:, :rank], whole[:, rank:]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    floor = 4 * EPS * max(np.linalg.norm(a), np.finfo(np.float64).tiny)

    def solve(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(block)
        if n == 1:
            return block.diagonal().copy(), np.eye(1)
        diagonal = np.sort(block.diagonal())
        if np.linalg.norm(block - np.diag(block.diagonal())) <= floor:
            return block.diagonal().copy(), np.eye(n)
        # Eigenvalues lie on both sides of the diagonal's mean, unless all are the same.
        for shift in ((diagonal[n // 2 - 1] + diagonal[n // 2]) / 2, diagonal.mean()):
            bases = _split(block, shift)
            if bases:
                break
        else:
            return _rotated(block, floor)
        parts = []
        for base in bases:
            inner = base.T @ block @ base
            values, vectors = solve((inner + inner.T) / 2)
            parts.append((values, base @ vectors))
        return np.concatenate([v for v, _ in parts]), np.hstack([v for _, v in parts])

    _, vectors = solve(a)
    # What rounding on many levels has left off the diagonal.
    values, turned = _rotated(vectors.T @ a @ vectors, floor)
    vectors = vectors @ turned
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    # The largest entry of a component is positive.
    at = np.abs(vectors).argmax(axis=0)
    return values[order], vectors * np.where(vectors[at, np.arange(len(at))] < 0, -1.0, 1.0)


def _rotated(block: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Rotates the largest entry off the diagonal away until none counts; for blocks that no shift parts, or nearly diagonal ones."""
    block, vectors = (block + block.T) / 2, np.eye(len(block))
    for _ in range(50 * len(block) ** 2):
        off = np.abs(np.triu(block, 1))
        i, j = np.unravel_index(off.argmax(), off.shape)
        if off[i, j] <= floor:
            break
        angle = 0.5 * np.arctan2(2 * block[i, j], block[i, i] - block[j, j])
        turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
        block[[i, j]] = turn.T @ block[[i, j]]
        block[:, [i, j]] = block[:, [i, j]] @ turn
        vectors[:, [i, j]] = vectors[:, [i, j]] @ turn
    return block.diagonal().copy(), vectors


def integers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The vectors of a batch, all as long, as integers."""
    column = batch.column(batch.schema.get_field_index(name))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = len(flat) // max(1, batch.num_rows)
    return np.floor(np.clip(flat * SCALE, -LIMIT, LIMIT)).astype(np.int64).reshape(batch.num_rows, width) + SHIFT


def _first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, 0, 0
    for batch in batches:
        if batch.num_rows:
            x = integers(batch, "__vector")
            n += batch.num_rows
            # In halves, which cannot overflow.
            high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
    if n:
        at = np.arange(len(high))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])


def _products(centre: np.ndarray):
    """Sums of the products of entries less their centre; whole numbers, exact below 2 ** 53."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), len(centre)))
        for batch in batches:
            if batch.num_rows:
                y = (integers(batch, "__vector") - centre).astype(np.float64)
                total += y.T @ y
        i, j = np.triu_indices(len(centre))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "sum"])

    return run


@dataclass
class Whitening:
    n: int
    sums: list[int]
    """Per dimension, exact."""
    values: np.ndarray
    """Eigenvalues of the components, falling."""
    vectors: np.ndarray
    """A component per column."""
    explained: np.ndarray
    """The eigenvalues' shares of the whole variance."""

    @property
    def centre(self) -> np.ndarray:
        """The integers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """The means less the centre; divided once, so all but exact."""
        return np.array([(s - self.n * int(c)) / self.n for s, c in zip(self.sums, self.centre)])


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``__vector`` of the vectors whose entries are all finite numbers.

    Of vectors of several lengths those of the commonest are left, of equally common ones the longest.
    An empty vector is none.
    """
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select("vec_id", values.alias("__vector")).filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    sizes = rows.groupBy(F.size("__vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("__vector") == (sizes["size"] if sizes else 0))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` as ``usable`` gives them; None without rows.

    Components of no variance are left out: there is nothing to divide by.
    """
    parts = rows.select("__vector").mapInArrow(_first_sums, "i bigint, n bigint, high bigint, low bigint")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    sums = sorted(parts.groupBy("i").agg(*wide).collect())
    if not sums:
        return None
    n = int(sums[0]["n"])
    made = Whitening(n, [(int(r["high"]) << 32) + int(r["low"]) for r in sums], *[np.zeros(0)] * 3)
    products = rows.select("__vector").mapInArrow(_products(made.centre), "i bigint, j bigint, sum double")
    square = np.zeros((len(sums), len(sums)))
    for r in products.groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect():
        square[r["i"], r["j"]] = square[r["j"], r["i"]] = r["sum"]
    covariance = square / n - np.outer(made.rest, made.rest)
    values, vectors = eigen(covariance)
    kept = np.flatnonzero(values > FLAT * max(values[0], 0))[:components]
    made.values, made.vectors = values[kept], vectors[:, kept]
    made.explained = values[kept] / np.trace(covariance) if len(kept) else np.zeros(0)
    return made


def _project(model: Whitening):
    weights = model.vectors / np.sqrt(model.values)
    bias, centre = model.rest @ weights, model.centre
    sums = np.array(model.sums, object)
    small = [int(s) - model.n * int(c) for s, c in zip(model.sums, centre)]

    def deviations(y: np.ndarray) -> list[int | None]:
        """(n * x - S) ** 2 summed, exact: n * x - S is n * y less a number of at most n / 2."""
        most = model.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * max(1, len(sums)) < 2**63:
            gap = model.n * y - np.array(small, np.int64)
            return (gap * gap).sum(axis=1).tolist()
        out = [sum((model.n * int(v) - s) ** 2 for v, s in zip(row, small)) for row in y]
        return [d if d < 2**63 else None for d in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = integers(batch, "__vector") - centre
                found = y.astype(np.float64) @ weights - bias
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
                columns = [batch.column(0), pa.array(deviations(y), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    return run


def _moments(k: int):
    """Sums of whitened entries and of their products, by (i, j); -1 stands for no second one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                once += w.sum(axis=0)
                twice += w.T @ w
        i, j = np.triu_indices(k)
        columns = [np.r_[np.arange(k), i], np.r_[np.full(k, -1), j], np.r_[once, twice[i, j]]]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["i", "j", "sum"])

    return run


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` (an array column) less the identity."""
    mean, square = np.zeros(k), np.zeros((k, k))
    parts = whitened.select("whitened").mapInArrow(_moments(k), "i bigint, j bigint, sum double")
    for r in parts.groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect():
        if r["j"] < 0:
            mean[r["i"]] = r["sum"] / n
        else:
            square[r["i"], r["j"]] = square[r["j"], r["i"]] = r["sum"] / n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


WHITENED = "vec_id bigint, deviation bigint, whitened array<double>"


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """``vec_id``, ``deviation`` and ``whitened``, an array with an entry per component; and the model.

    Null vectors, and those with an entry that is null or not finite, are dropped; see also ``usable``.
    ``deviation`` is the sum over dimensions of (n * x - S) ** 2, null if it is beyond a BIGINT. Without
    variance, as of one vector or of copies of it, there are no components and ``whitened`` is empty; without
    vectors there are no rows and no model. ``vec_id`` may be null, and repeated rows come back as often.
    """
    rows = usable(embeddings, vector)
    model = fit(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], WHITENED), None
    if not len(model.values):
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened")), model
    return stored(rows.mapInArrow(_project(model), WHITENED), "whitened"), model
