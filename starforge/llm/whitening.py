"""Whitening of vectors; principal components by QDWH spectral divide and conquer.

The polar factor of a shifted symmetric matrix has the eigenvalues 1 and -1, on the subspaces above
and below the shift.  It comes from dynamically weighted Halley steps, each a QR factorisation, so
nothing but QR factorisations and products is needed.  Half of one plus the factor projects onto
the upper subspace; bases of the two subspaces split the matrix into two smaller ones, which are
split in turn, until blocks have one row.  The matrix is the covariance; it is gathered in one
distributed pass, has a row per dimension, and is split on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import LONG, as_integers, column_sums, complete, largest, matrix, stored
from starforge.session import ship_package

col = F.col

EPS = np.finfo(np.float64).eps


# --------------------------------------------------------------------------- spectral divide and conquer


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix without the eigenvalue zero, by QDWH steps."""
    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, EPS))  # no singular value of x is smaller
    eye = np.eye(n)
    for _ in range(40):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        a0 = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d))) / 2
        b0 = (a0 - 1) ** 2 / 4
        c0 = a0 + b0 - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c0) * x, eye]))
        new = b0 / c0 * x + (a0 - b0 / c0) / np.sqrt(c0) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        change, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (a0 + b0 * low**2) / (1 + c0 * low**2))
        if 1 - low < 10 * EPS and change < np.cbrt(EPS):
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of the rest, by subspace iteration."""
    n = len(projector)
    start = np.random.default_rng(n).standard_normal((n, rank))
    q, _ = np.linalg.qr(projector @ start)
    q, _ = np.linalg.qr(projector @ q, mode="complete")
    return q[:, :rank], q[:, rank:]


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces, the one of the larger eigenvalues first; None for a multiple of one."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    scale = np.linalg.norm(a)
    if spread <= n * EPS * scale:
        return None
    best = None
    # the median splits evenly, the mean splits always; shifts beside it avoid an eigenvalue that lies on it
    shifts = [np.median(np.diag(a)), mean, *(mean + f * spread / n for f in (0.1, -0.1, 0.3, -0.3))]
    for shift in shifts:
        u = polar(a - shift * np.eye(n))
        rank = int(np.rint((np.trace(u) + n) / 2))
        if not 0 < rank < n:
            continue
        upper, lower = _bases((u + np.eye(n)) / 2, rank)
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 10 * n * EPS * scale:
            break
    return None if best is None else best[1:]


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors.

    Blocks are split from the largest eigenvalues down, and only as far as they are asked for.
    """
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [np.eye(len(a))]
    while todo and len(values) < most:
        basis = todo.pop()
        block = basis.T @ a @ basis
        parts = _split((block + block.T) / 2) if len(block) > 1 else None
        if parts is not None:
            todo += [basis @ parts[1], basis @ parts[0]]
            continue
        for v in basis.T:  # one row, or all eigenvalues equal
            v = v / np.linalg.norm(v)
            values.append(float(v @ a @ v))
            vectors.append(v)
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.array(vectors).reshape(-1, len(a))[order].T


# --------------------------------------------------------------------------- fitting


@dataclass(frozen=True)
class Whitening:
    """Fit over ``n`` distinct vectors: sums per dimension, components as columns, their eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.centre()) @ self.components / np.sqrt(self.eigenvalues)


# Rows turned into doubles at a time.
STEP = 8192


def _sums(dim: int):
    """Rows and exact sums per dimension of a task, as (at, n, s)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            rows = matrix(batch.column("x"), dim)
            n, total = n + len(rows), total + column_sums(rows)
        if n:
            at = pa.array(np.arange(dim), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([n] * dim), pa.array([str(s) for s in total])], ["at", "n", "s"])

    return add


def _covariances(dim: int, transform):
    """Sums of products of the rows of a task, after ``transform`` has centred them: (i, j, s), j >= i."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            rows = matrix(batch.column("x"), dim)
            for start in range(0, len(rows), STEP):
                y = transform(rows[start : start + STEP].astype(np.float64))
                total = total + y.T @ y
        if isinstance(total, float):
            return
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    return add


def _gathered(points: DataFrame, n: int, dim: int, size: int, transform) -> np.ndarray:
    """A covariance with divisor ``n``; the driver gets one row per pair of dimensions."""
    parts = points.select("x").mapInArrow(_covariances(dim, transform), "i int, j int, s double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["s"] / n
    return out


def fit(points: DataFrame, dim: int, most: int) -> Whitening:
    """Fit to the distinct vectors ``points`` (x), of which there is one at least.

    Components whose variance is zero, up to rounding, cannot be whitened and are left out.
    """
    ship_package(points.sparkSession)
    parts = points.select("x").mapInArrow(_sums(dim), "at int, n long, s string").groupBy("at")
    sums = parts.agg(F.sum("n").alias("n"), F.sum(col("s").cast("decimal(38,0)")).alias("s")).collect()
    by_place = {r["at"]: int(r["s"]) for r in sums}
    n, totals = sums[0]["n"], [by_place[i] for i in range(dim)]
    centre = np.array([s / n for s in totals])
    v = _gathered(points, n, dim, dim, lambda y: y - centre)
    values, components = leading(v, most)
    real = values > dim * EPS * max(values.max(), 0.0)
    found = Whitening(n, totals, components[:, real], values[real], float(np.trace(v)), 0.0)
    size = int(real.sum())
    if not size:
        return found
    spread = _gathered(points, n, dim, size, found.whitened)  # centred before it is turned
    return Whitening(n, totals, found.components, found.eigenvalues, found.trace, float(np.abs(spread - np.eye(size)).max()))


# --------------------------------------------------------------------------- whitening


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of integer rows, exact; null beyond the range of a long."""
    most = largest(rows) * n + max(abs(s) for s in sums)
    kind = np.int64 if rows.shape[1] * most**2 <= LONG else object
    apart = rows.astype(kind) * n - np.array(sums, dtype=kind)
    return [int(d) if d <= LONG else None for d in (apart * apart).sum(axis=1)]


def whitened(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = 256, most: int = 4) -> tuple[DataFrame, Whitening | None]:
    """((id, component, n, deviation, whitened, explained, identity_error) per vector and component, fit).

    Vectors that are null or empty, or hold null or non-finite components, are dropped.  The others
    should have one length; if not, the most frequent one counts (of equally frequent ones the
    greatest) and the rest is dropped.  Components become integers.  Each distinct vector enters the
    fit once, so repeated rows, also a third of the table, change nothing; they are reduced before
    they are shuffled.  Every row is returned, null ids too.  Components are numbered from 1 by
    falling eigenvalue; of equal eigenvalues any unit vectors of their subspace serve, the same for
    all rows.  A table with fewer than two distinct vectors, or an empty one, has no component and
    gives an empty result.  A deviation beyond the range of a long is null.  Other columns are
    ignored, whatever their names.

    Tasks send one value per pair of dimensions; the fit is broadcast and has ``dim * most`` values.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(col(id_).alias("id"), col(vector).alias("v")).where(complete(col("v")))
    rows = rows.select("id", as_integers(col("v"), scale).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    schema = (
        f"{id_} {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    if lengths is None:
        return spark.createDataFrame([], schema), None
    dim = lengths["dim"]
    rows = rows.where(F.size("x") == dim)
    found = fit(stored(rows.select("x").distinct(), "fit-list"), dim, most)
    size = found.components.shape[1]
    explained = found.eigenvalues / found.trace if size else np.zeros(0)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(batch.column("x"), dim)
            for start in range(0, len(whole), STEP):
                x = whole[start : start + STEP]
                w = found.whitened(x.astype(np.float64))
                own, many = pa.array(np.repeat(np.arange(len(x)), size)), size * len(x)
                out = {
                    id_: batch.column("id").slice(start, len(x)).take(own),
                    "component": pa.array(np.tile(np.arange(1, size + 1), len(x)), pa.int32()),
                    "n": pa.array(np.full(many, found.n), pa.int64()),
                    "deviation": pa.array(deviations(x, found.n, found.sums), pa.int64()).take(own),
                    "whitened": pa.array(w.ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(many, found.identity_error)),
                }
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return rows.mapInArrow(give, schema), found
