"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the factor.

Entries become integers, so that counts, sums and the scatter are exact whatever the
order of rows.  First pass: number of vectors and sums per dimension.  Second pass: the
scatter of the vectors minus their rounded mean, centred before multiplying; what the
rounding left is taken off exactly, which gives n^2 times the covariance as integers.
That matrix (dim x dim) is factored on the driver in extended precision: a Cholesky
factorisation with diagonal pivoting, then Jacobi rotations of pairs of the triangular
factor's columns until all are orthogonal.  The squared norms of the rotated columns are
the eigenvalues, the normalised columns the components.  Third pass: the covariance of
the whitened vectors as written, for ``identity_error``; last pass: the rows.

Scale.  No row is shuffled: a task sends one matrix of sums, whatever it read.  The driver
holds a dim x dim matrix.  The table is read four times and never copied.

Defined cases: vectors that are null or hold null or non-finite entries have no row; so
have vectors of another length than most usable ones have (ties: the longer), as their
missing entries are null; repeated rows count and are returned as often as they occur;
null ids pass through; components of eigenvalue zero (beyond the scatter's rank, so all
of a single vector's) cannot be whitened and have no row; an empty table gives an empty
result; ``deviation`` is null where the exact value does not fit a long; other columns do
not matter.  Entries of 2^31 and more after scaling are an error.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglynx.llm import vectors
from loglynx.llm.common import cut

LIMIT = 1 << 31
BLOCK = 4096  # vectors multiplied at once
EXACT = 1 << 53  # integers below are exact as doubles


def gram(z: np.ndarray) -> np.ndarray:
    """z^T z of integers, exactly (Python integers where 64 bits do not do)."""
    top = int(np.abs(z).max()) if z.size else 0
    if top * top * len(z) < EXACT:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    high, low = z >> 16, z & 0xFFFF
    a, b = high.astype(np.float64), low.astype(np.float64)
    whole = lambda m: m.astype(np.int64).astype(object)  # noqa: E731  (below 2^33 times 4,096 rows: exact)
    cross = whole(a.T @ b)
    return whole(a.T @ a) * (1 << 32) + (cross + cross.T) * (1 << 16) + whole(b.T @ b)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """The factor g (dim x rank) with a = g g^T: rows in a's order, the columns those of a
    triangle once the rows are put in the order of the pivots."""
    a = a.copy()
    dim = len(a)
    g = np.zeros_like(a)
    left = np.arange(dim)
    floor = np.finfo(a.dtype).eps * dim * max(a.diagonal().max(initial=0), 0)
    for step in range(dim):
        p = left[np.argmax(a[left, left])]
        if not a[p, p] > floor:
            return g[:, :step]
        g[left, step] = a[left, p] / np.sqrt(a[p, p])
        left = left[left != p]
        a[np.ix_(left, left)] -= np.outer(g[left, step], g[left, step])
    return g


def jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of g g^T, falling: columns are rotated pairwise,
    disjoint pairs together, until all are orthogonal."""
    rank = g.shape[1]
    if not rank:
        return g[0, :0], g
    u = np.concatenate([g, np.zeros((len(g), rank % 2), g.dtype)], 1)
    m = u.shape[1]
    small = np.finfo(g.dtype).eps * 8
    ring = np.arange(m)
    for _ in range(sweeps):
        worst = 0
        for _ in range(m - 1):
            i, j = ring[: m // 2], ring[::-1][: m // 2]
            x, y = u[:, i], u[:, j]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(a * b)
            off = np.where(scale > 0, np.abs(c) / np.where(scale > 0, scale, 1), 0)
            worst = max(worst, off.max())
            turn = off > small
            zeta = (b - a) / np.where(turn, 2 * c, 1)
            t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0)
            cos = 1 / np.sqrt(1 + t * t)
            u[:, i], u[:, j] = cos * x - cos * t * y, cos * t * x + cos * y
            ring = np.concatenate([ring[:1], ring[-1:], ring[1:-1]])
        if worst <= small:
            break
    else:
        raise RuntimeError("the rotations did not settle")
    values = (u * u).sum(0)
    order = np.argsort(-values, kind="stable")[:rank]
    u = u[:, order] / np.sqrt(values[order])
    peak = u[np.abs(u).argmax(0), np.arange(rank)]
    return values[order], u * np.where(peak < 0, -1, 1)


class Fit:
    """n, exact sums, and the leading components of the fit list."""

    def __init__(self, n: int, sums: list[int], scatter: list[list[int]], components: int):
        self.n, self.dim = n, len(sums)
        self.sums = sums
        self.center = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(c) for s, c in zip(sums, self.center)]  # n * (mean - center), exactly
        exact = np.array([[n * scatter[i][j] - self.rest[i] * self.rest[j] for j in range(self.dim)] for i in range(self.dim)], object)
        v = np.array([[np.longdouble(str(t)) for t in row] for row in exact], np.longdouble) / np.longdouble(n) / np.longdouble(n)
        values, u = jacobi(pivoted_cholesky(v))
        keep = min(components, len(values))
        trace = v.diagonal().sum()
        self.explained = (values[:keep] / trace).astype(np.float64)
        self.turn = (u[:, :keep] / np.sqrt(values[:keep])).astype(np.float64)
        self.offset = np.array([float(np.longdouble(str(r)) / n) for r in self.rest])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center).astype(np.float64) - self.offset) @ self.turn

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n * x - sum)^2, exactly; null beyond 64 bits."""
        z = x - self.center
        top = max((int(np.abs(z).max()) + 1) * self.n, 1) if z.size else 1
        if top * top * self.dim < 1 << 63:
            return ((z * self.n - np.array(self.rest)) ** 2).sum(1)
        whole = ((z.astype(object) * self.n - np.array(self.rest, object)) ** 2).sum(1)
        return np.array([t if t < 1 << 63 else None for t in whole], object)


def _ints(batches, dim: int | None, scale: int, offset: int):
    for batch in batches:
        for n, (at, m) in vectors.matrices(batch.column(1)).items():
            if dim is None or n == dim:
                for a in range(0, len(at), BLOCK):
                    yield batch.column(0), at[a:a + BLOCK], vectors.scaled(m[a:a + BLOCK], scale, LIMIT) + offset


def _summed(parts: DataFrame, width: int) -> dict[int, list]:
    """The sum of the tasks' matrices, sent as rows (i, v): {i: row}."""
    total = parts.groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)])
    return {r["i"]: list(r[1:]) for r in total.collect()}  # a row for each dimension


def fit(rows: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000,
        key: str = "vec_id", vector: str = "embedding") -> Fit | None:
    """The fit over all usable vectors; none if there are none."""
    inner = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    number = pa.decimal128(38, 0)

    def first(batches):
        held: dict[int, list] = {}
        for _, at, x in _ints(batches, None, scale, offset):
            now = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            now[0] += len(at)
            now[1] += x.sum(0).astype(object)  # 2^31 times 4,096 rows fit
        for dim, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim]), pa.array([n]), pa.array([_decimals(s)], pa.list_(number))], names=["dim", "n", "v"])

    counts = cut(inner.mapInArrow(first, "dim long, n long, v array<decimal(38,0)>"))  # a row for each task and length
    lengths = counts.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if lengths is None or not lengths["dim"]:
        return None
    dim, n = lengths["dim"], lengths["n"]
    sums = [int(s) for s in counts.where(F.col("dim") == dim).agg(*[F.sum(F.col("v")[j]) for j in range(dim)]).first()]
    center = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)

    def second(batches):
        total = np.zeros((dim, dim), object)
        for _, _, x in _ints(batches, dim, scale, offset):
            total += gram(x - center)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array([_decimals(r) for r in total], pa.list_(number))], names=["i", "v"])

    parts = inner.mapInArrow(second, "i long, v array<decimal(38,0)>")
    found = _summed(parts, dim)  # empty if all vectors are equal
    return Fit(n, sums, [[int(t) for t in found.get(i, [0] * dim)] for i in range(dim)], components)


def _decimals(values) -> list[decimal.Decimal]:
    return [decimal.Decimal(int(v)) for v in values]


def whiten(rows: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000,
           key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    inner = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    kind = inner.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, components, scale, offset, key, vector)
    if model is None or not model.turn.shape[1]:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    width = model.turn.shape[1]

    def third(batches):
        total, s = np.zeros((width, width)), np.zeros(width)
        for _, _, x in _ints(batches, model.dim, scale, offset):
            w = model.whiten(x)
            total += w.T @ w
            s += w.sum(0)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1)), pa.array([*total.tolist(), s.tolist()])], names=["i", "v"])

    parts = inner.mapInArrow(third, "i long, v array<double>")
    found = _summed(parts, width)
    m = np.array([found[i] for i in range(width + 1)]) / model.n
    error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(width)).max())

    def last(batches):
        for keys, at, x in _ints(batches, model.dim, scale, offset):
            n = len(at)
            each = np.repeat(at, width)
            tell = pa.array(model.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays([
                keys.take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n)), pa.array(np.full(n * width, model.n)),
                tell.take(pa.array(np.repeat(np.arange(n), width))), pa.array(model.whiten(x).reshape(-1)),
                pa.array(np.tile(model.explained, n)), pa.array(np.full(n * width, error))],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return inner.mapInArrow(last, schema).withColumnRenamed("key", key)
