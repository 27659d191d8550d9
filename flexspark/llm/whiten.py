"""Whitening of vectors by their leading principal components, the components found by contour integration (FEAST).

Every entry c becomes the integer x = floor(256 c). Each distinct x vector counts once (the fit list). Sums and products are added up in whole
numbers in the tasks: first the sums S, then products of z = x - floor(S / n), whose entries stay small. The covariance V follows exactly,
(n Σzz' - RR') / n² with R = S - n floor(S / n), and is rounded once. It is of the vectors' dimension squared; that is all the driver gets.

Components of V (``components``): the eigenvalue interval is narrowed by inertia counts of V - sI (signs of a symmetric factorisation with
pivots of one or two rows) until it holds the wanted ones and few others. A random block is filtered by Gauss-Legendre quadrature of the
resolvent (zI - V)^-1 along a circle through the interval's ends, one complex solve for each node; Rayleigh-Ritz on the filtered block gives values
and vectors, and the next block. It ends when the residuals no longer fall and the values inside are as many as the inertia
counts say; otherwise the block grows, at most to the whole space.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flexspark.sources.scratch import stage

SCALE, NODES, ROUNDS = 256, 8, 30
LONG = 1 << 63


def above(a: np.ndarray, s: float) -> int:
    """How many eigenvalues of the symmetric matrix are above s: positive pivots of a - sI, by Sylvester's law of inertia."""
    m = a - s * np.eye(len(a))
    count, alpha = 0, (1 + 17**0.5) / 8
    while len(m):
        off = np.abs(m - np.diag(np.diag(m)))
        p, q = np.unravel_index(np.argmax(off), off.shape)
        r = int(np.argmax(np.abs(np.diag(m))))
        if abs(m[r, r]) >= alpha * off[p, q]:
            if m[r, r] == 0:
                break
            count += m[r, r] > 0
            rest = np.delete(np.arange(len(m)), r)
            m = m[np.ix_(rest, rest)] - np.outer(m[rest, r], m[rest, r] / m[r, r])
        else:
            count += 1  # such a pair of rows has one positive and one negative eigenvalue
            rest = np.delete(np.arange(len(m)), [p, q])
            c = m[np.ix_(rest, [p, q])]
            m = m[np.ix_(rest, rest)] - c @ np.linalg.solve(m[np.ix_([p, q], [p, q])], c.T)
    return int(count)


def _filtered(v: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenvalue interval: quadrature over the upper half of the circle, the lower one being its conjugate."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(y)
    for t, w in zip(*np.polynomial.legendre.leggauss(NODES)):
        turn = radius * np.exp(1j * np.pi * (1 - t) / 2)
        out += w / 2 * (turn * np.linalg.solve((centre + turn) * np.eye(len(v)) - v, y.astype(complex))).real
    return out


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance, falling, and unit eigenvectors as columns; values that rounding can't tell from 0 are none."""
    d, norm = len(v), float(np.abs(v).sum(axis=1).max(initial=0.0))
    if norm == 0 or not np.isfinite(norm):
        return np.zeros(0), np.zeros((d, 0))
    a, nothing = v / norm, 4 * d * np.finfo(float).eps
    low, high = nothing, 1.01
    count = above(a, low)
    k, top = min(k, count), high
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    while count > max(2 * k, k + 4) and top - low > 1e-9:
        middle = (low + top) / 2
        n = above(a, middle)
        if n >= k:
            low, count = middle, n
        else:
            top = middle
    size = min(d, 2 * count + 4)
    while True:
        y = np.random.default_rng(size).standard_normal((d, size))
        best = np.inf
        for _ in range(ROUNDS):
            q, _ = np.linalg.qr(_filtered(a, y, low, high))
            e, s = np.linalg.eigh(q.T @ a @ q)
            y = q @ s
            e, y = e[::-1], y[:, ::-1]
            inside = int((e > low).sum())
            residual = np.linalg.norm(a @ y[:, :k] - y[:, :k] * e[:k], axis=0).max()
            if inside == count and residual >= best / 2:
                break
            best = min(best, residual) if inside == count else np.inf
        if size == d or inside == count and residual < 1e-13 and above(a, e[k - 1] * (1 - 1e-9) - nothing) >= k:
            break
        size = min(d, 2 * size)
    e, y = e[:k], y[:, :k]
    return e * norm, y * np.where(y[np.argmax(np.abs(y), axis=0), np.arange(k)] < 0, -1.0, 1.0)


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not empty, no null or non-finite entry."""
    c = F.col(f"`{vector}`")
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & fine, F.lit(False))


def whole(vector: str) -> Column:
    """The vector's integers."""
    return F.transform(F.col(f"`{vector}`"), lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, d: int, pairs: bool, minus: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums over all rows: of each entry, or of all products of two entries of x - minus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d) if pairs else (d,), dtype=object)
        some, room = np.zeros(total.shape, np.int64), 1 << 62
        for batch in batches:
            x = _matrix(batch, d)
            z = x.astype(object) - np.array(minus, dtype=object) if max(abs(m) for m in minus) >= 1 << 40 or np.abs(x).max(initial=0) >= 1 << 40 else x - np.array(minus)
            most = int(np.abs(z).max(initial=0))
            bound = len(z) * most * (most if pairs else 1)
            if bound >= 1 << 62:
                total += z.astype(object).T @ z.astype(object) if pairs else z.astype(object).sum(axis=0)
                continue
            if bound >= room:
                total, some, room = total + some, np.zeros(total.shape, np.int64), 1 << 62
            room -= bound
            if not pairs:
                some += z.astype(np.int64).sum(axis=0)
            elif bound < 1 << 53:  # then doubles add whole numbers exactly
                f = z.astype(float)
                some += (f.T @ f).astype(np.int64)
            else:
                i = z.astype(np.int64)
                some += i.T @ i
        total = total + some
        i, j = np.triu_indices(d) if pairs else (np.arange(d), np.zeros(d, int))
        v = total[i, j] if pairs else total
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(n)) for n in v], pa.decimal128(38, 0))], names=["i", "j", "v"])

    got = rows.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return {(r["i"], r["j"]): int(r["v"]) for r in got.collect()}  # the dimension, or half its square


class Whitening:
    """What the fit found: n and sums S of the fit list, covariance, eigenvalues and components, largest error of the whitened covariance."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.covariance, self.values, self.vectors = n, sums, covariance, values, vectors
        self.identity_error = 0.0

    @property
    def explained(self) -> list[float]:
        trace = float(np.trace(self.covariance))
        return [float(e) / trace for e in self.values]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they fit."""
    big = max(int(np.abs(x).max(initial=0)) * n, *(abs(s) for s in sums)) >= 1 << 61
    return x.astype(object) * n - np.array(sums, dtype=object) if big else x * n - np.array(sums, dtype=np.int64)


def _projected(centred: np.ndarray, n: int, factor: np.ndarray) -> np.ndarray:
    return (centred / n).astype(float) @ factor


def fit(df: DataFrame, vector: str, k: int) -> tuple[Whitening | None, DataFrame]:
    """The whitening, None without usable vectors, and the rows that take part with their integers as column ``x`` (columns named x are replaced)."""
    rows = df.where(usable(vector)).withColumn("x", whole(vector))
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return None, rows
    d = size["d"]
    rows = rows.where(F.size("x") == d)
    listed = stage(rows.select("x").distinct(), "vectors")
    n = listed.count()
    sums = [s for _, s in sorted(_summed(listed, d, False, [0] * d).items())]
    near = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, near)]
    v = np.zeros((d, d))
    for (i, j), p in _summed(listed, d, True, near).items():
        v[i, j] = v[j, i] = (n * p - rest[i] * rest[j]) / (n * n)
    values, vectors = components(v, k)
    out = Whitening(n, sums, v, values, vectors)
    if len(values):
        out.identity_error = _error(listed, out)
    return out, rows


def _error(listed: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the fit list's whitened covariance minus the identity, from the rows themselves."""
    d, k = len(w.sums), len(w.values)
    shared = listed.sparkSession.sparkContext.broadcast((w.n, w.sums, w.vectors / np.sqrt(w.values)))
    names = [f"c{i}" for i in range(k + k * k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, factor = shared.value
        total = np.zeros(k + k * k)
        for batch in batches:
            y = _projected(_centred(_matrix(batch, d), n, sums), n, factor)
            total += np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], names=names)

    got = np.array(listed.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c) for c in names]).first()) / w.n
    return float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())


def whiten(df: DataFrame, vector: str = "embedding", k: int = 4, key: str = "vec_id") -> tuple[DataFrame, Whitening | None]:
    """(key, deviation, whitened) of every vector that takes part, one pass without shuffle, and what the fit found.

    Null and empty vectors and those with null or non-finite entries take no part, nor do vectors of another length than the most frequent one (of
    lengths as frequent, the larger). Entries beyond long after scaling become the nearest long. Repeated rows and null keys each give a row; the
    fit counts equal vectors once. There are fewer than k components where V has fewer non-zero eigenvalues. ``deviation``, Σ(n x - S)², is null
    where it exceeds a long. No usable vectors: no rows, None.
    """
    found, rows = fit(df, vector, k)
    rows = rows.select(F.col(f"`{key}`").alias("key"), "x")
    kind = dict(rows.dtypes)["key"]
    d = len(found.sums) if found else 1
    shared = rows.sparkSession.sparkContext.broadcast((found.n, found.sums, found.vectors / np.sqrt(found.values)) if found else (1, [0], np.zeros((1, 0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, factor = shared.value
        for batch in batches:
            c = _centred(_matrix(batch, d), n, sums)
            most = int(np.abs(c).max(initial=0))
            square = (c * c).sum(axis=1) if d * most * most < LONG else [int(s) if s < LONG else None for s in (c.astype(object) ** 2).sum(axis=1)]
            y = _projected(c, n, factor)
            at = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(square, pa.int64()), pa.ListArray.from_arrays(at, pa.array(y.ravel()))], names=["key", "deviation", "whitened"])

    return rows.mapInArrow(run, f"key {kind}, deviation long, whitened array<double>").withColumnRenamed("key", key), found
