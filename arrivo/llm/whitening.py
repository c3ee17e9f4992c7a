"""Operator 12, embedding whitening by pivoted Cholesky and one-sided Jacobi.

Each entry c of a vector becomes the whole number floor(1024 c) + 100000. Two
passes over the table fit the model: exact sums per dimension, then the
scatter of the centred numbers. Every partition adds up its own rows and
returns one small table, so the shuffle grows with dimensions and partitions
and not with rows. Centring takes the whole part of the mean from the whole
numbers, so products stay small and sums of them exact; the fraction that
is left of the mean is taken off the scatter afterwards.

The driver holds one matrix of dimensions x dimensions. Pivoted Cholesky
gives a triangular factor of the covariance; one-sided Jacobi rotates the
factor's columns until they are orthogonal. Their squared norms are the
eigenvalues, the columns scaled to norm 1 the components.

A third pass measures the covariance of the whitened rows, a fourth returns
them. Left out are vectors that are null, hold null or non-finite entries,
entries of ``LARGEST`` or more in size (their numbers are no exact doubles),
or have another length than most (of equally common lengths the shortest
counts). Repeated rows count and return as often as they occur; null ids stay.
Components without variance (fewer distinct vectors than dimensions) have a
null ``whitened`` and ``explained`` 0 (null if nothing varies) and don't count
in ``identity_error``; a deviation beyond 64 bits is null. Vectors without
entries and tables without vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import table

# fixed by the data contract: x = floor(SCALE * entry) + OFFSET
SCALE, OFFSET = 1024.0, 100_000
COMPONENTS = 8
LARGEST = 2.0 ** 36
#: Rows of a batch that are worked on at once.
BLOCK = 4_096
SWEEPS = 60


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``rows`` vectors with the exact per-dimension
    ``sums``; column i of ``components`` belongs to ``eigenvalues[i]``,
    ``explained[i]`` is its share of the trace."""
    rows: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) with vec as doubles, without the rows left out for
    their entries."""
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return vectors.filter(F.col("vec").isNotNull() & ~bad).select(
        "vec_id", F.col("vec").cast("array<double>").alias("vec"))


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, whole numbers) of the rows of a partition."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            entries = part.column("vec").flatten().to_numpy(zero_copy_only=False)
            yield part.column("vec_id"), np.floor(entries.reshape(-1, dim) * SCALE).astype(np.int64) + OFFSET


def _sums(vectors: DataFrame, dim: int) -> list[int]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for _, x in blocks(batches, dim):
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], ["pos", "total"])

    parts = vectors.mapInArrow(add, "pos int, total decimal(38,0)")
    return [int(r["s"]) for r in parts.groupBy("pos").agg(F.sum("total").alias("s")).orderBy("pos").collect()]


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """Sums of ``value`` by ``pos`` (0 to size - 1)."""
    out = np.zeros(size)
    for r in parts.groupBy("pos").agg(F.sum("value").alias("s")).collect():
        out[r["pos"]] = r["s"]
    return out


def _numbered(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                      ["pos", "value"])


def covariance(vectors: DataFrame, rows: int, sums: list[int]) -> np.ndarray:
    """Covariance (divisor ``rows``) of the whole numbers."""
    dim = len(sums)
    middle = np.array([s // rows for s in sums], dtype=np.int64)
    upper = np.triu_indices(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for _, x in blocks(batches, dim):
            y = (x - middle).astype(np.float64)
            total += y.T @ y
        yield _numbered(total[upper])

    scatter = np.zeros((dim, dim))
    scatter[upper] = _added(vectors.mapInArrow(add, "pos int, value double"), len(upper[0]))
    scatter += np.triu(scatter, 1).T
    left = np.array([(s - rows * int(m)) / rows for s, m in zip(sums, middle)])
    return scatter / rows - np.outer(left, left)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): ``a[order][:, order] = factor @ factor.T`` with a lower
    triangular factor that has one column for each pivot above rounding."""
    d = len(a)
    order, left = np.arange(d), a.diagonal().copy()
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        if left[order[p]] <= least:
            return factor[:, :k], order
        order[[k, p]], factor[[k, p]] = order[[p, k]], factor[[p, k]]
        own, rest = order[k], order[k + 1:]
        factor[k, k] = np.sqrt(left[own])
        factor[k + 1:, k] = (a[rest, own] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        left[rest] -= factor[k + 1:, k] ** 2
    return factor, order


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated against each other until they are
    orthogonal. A round rotates disjoint pairs at once; the rounds of a sweep
    bring every two columns together."""
    g = factor.copy()
    d, r = g.shape
    seats = np.arange(r + r % 2)
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            p, q = seats[:len(seats) // 2], seats[len(seats) // 2:][::-1]
            both = (p < r) & (q < r)
            p, q = p[both], q[both]
            a, b = g[:, p], g[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            off = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, off.max(initial=0.0))
            turn = off > 1e-16
            zeta = (bb - aa) / (2 * np.where(turn, ab, 1.0))
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, p], g[:, q] = c * (a - t * b), c * (t * a + b)
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= d * np.finfo(float).eps:
            break
    return g


def eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns), without those of
    eigenvalue zero."""
    factor, order = pivoted_cholesky(cov)
    if not factor.shape[1]:
        return np.empty(0), np.empty((len(cov), 0))
    turned = np.empty_like(factor)
    turned[order] = jacobi(factor)
    norms = np.sqrt((turned ** 2).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    return norms[by] ** 2, turned[:, by] / norms[by]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The transform of the rows of ``vectors`` (vec_id, vec) that take part;
    None if there are none."""
    clean = usable(vectors)
    lengths = clean.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"))
    shape = lengths.orderBy(F.desc("n"), "dim").limit(1).collect()
    if not shape or not shape[0]["dim"]:
        return None
    dim, rows = shape[0]
    clean = clean.filter(F.size("vec") == dim)
    sums = _sums(clean, dim)
    cov = covariance(clean, rows, sums)
    values, columns = eigen(cov)
    return Whitening(rows, tuple(sums), columns[:, :components], values[:components],
                     values[:components] / np.trace(cov))


def whitened_of(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Whitened coordinates of whole-number rows."""
    middle = np.array([s // model.rows for s in model.sums], dtype=np.int64)
    left = np.array([(s - model.rows * int(m)) / model.rows for s, m in zip(model.sums, middle)])
    return ((x - middle) - left) @ model.components / np.sqrt(model.eigenvalues)


def deviations(model: Whitening, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (rows * x - sum)^2, exact; None beyond 64 bits."""
    middle = np.array([s // model.rows for s in model.sums], dtype=np.int64)
    left = np.array([s - model.rows * int(m) for s, m in zip(model.sums, middle)], dtype=np.int64)
    y = x - middle
    if (model.rows * (float(np.abs(y).max(initial=0)) + 1)) ** 2 * model.dim < 2.0 ** 62:
        return ((model.rows * y - left) ** 2).sum(axis=1).tolist()
    out = ((model.rows * y.astype(object) - left.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < 2 ** 63 else None for v in out]


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened rows' covariance minus the
    identity, measured on all rows of ``vectors`` that take part."""
    k, dim = len(model.eigenvalues), model.dim

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in blocks(batches, dim):
            w = whitened_of(model, x)
            first += w.sum(axis=0)
            second += w.T @ w
        yield _numbered(np.concatenate([first, second.ravel()]))

    rows = usable(vectors).filter(F.size("vec") == dim)
    got = _added(rows.mapInArrow(add, "pos int, value double"), k + k * k) / model.rows
    # the rows are centred already; this takes off the rounding that is left
    cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    return float(np.abs(cov - np.eye(k)).max(initial=0.0))


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that takes part and each component up to
    ``components`` or the number of dimensions."""
    model = fit(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    error = identity_error(vectors, model)
    dim, known = model.dim, len(model.eigenvalues)
    k = min(components, dim)
    share = [*model.explained.tolist(), *[0.0 if known else None] * (k - known)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks(batches, dim):
            n = len(x)
            each = np.repeat(np.arange(n), k)
            w = np.full((n, k), np.nan)
            w[:, :known] = whitened_of(model, x)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, model.rows)), pa.array(deviations(model, x), pa.int64()).take(pa.array(each)),
                pa.array(w.ravel(), mask=np.isnan(w.ravel())), pa.array(share * n, pa.float64()),
                pa.array(np.full(n * k, error))], [c.split()[0] for c in RESULT.split(", ")])

    rows = usable(vectors).filter(F.size("vec") == dim)
    return rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(run, RESULT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec")))
