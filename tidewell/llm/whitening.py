"""Operator 12: whitening of embeddings, covariances by polarisation.

The covariance of two dimensions follows from three variances:
``2 cov(a, b) = var(a + b) - var(a) - var(b)``. So the cluster adds up nothing
but squares of centred values, one sum for every dimension and one for the sum
of every pair of dimensions, as whole numbers and hence exactly. Two passes:
sums first, then squares of values centred at the whole number next to each
mean; the rest of the centring (less than one half) is settled in the sums,
exactly too. Tasks hand on one row per sum; the driver holds the
``d (d + 1) / 2`` sums and the covariance matrix for ``eigh`` (``d`` is the
vectors' length, whatever the corpus). A last pass projects the rows.

Results for odd rows: a vector that is null or holds a null or non-finite entry
is left out. The dimension is the most common length of the remaining vectors
(ties: the longer); vectors of other lengths are left out, as are empty ones.
``floor(scale * entry)`` is held within +-2^40. A null id is kept, repeated rows
count as often as they come, an empty table gives an empty table. A component
without variance (eigenvalue up to 1e-12 of the largest) cannot be whitened: its
``whitened`` is null, its ``explained`` what it is, and ``identity_error`` is
over the others (null if there are none). ``deviation`` is null where it does
not fit a long. Further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Whole numbers are held within plus or minus this, before the shift.
BOUND = 1 << 40
#: Vectors that a task handles at a time.
BLOCK = 1024
#: Eigenvalues up to this share of the largest count as none.
FLAT = 1e-12
_SAFE = 1 << 62


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, x (longs): the usable vectors."""
    v = F.col(vec_col).cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(BOUND))), F.lit(
        -float(BOUND)))) + SHIFT)
    rows = vectors.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).where(~odd).select(
        F.col(id_col).cast("long").alias("id"), held.cast("array<long>").alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (common["d"] if common else 0))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for b in batches:
        for k in range(0, len(b), BLOCK):
            part = b.iloc[k:k + BLOCK]
            yield part, np.array(part["x"].tolist(), dtype=np.int64)


def _added(totals: dict[tuple[int, int], int]) -> pd.DataFrame:
    return pd.DataFrame([(i, j, str(t)) for (i, j), t in totals.items()], columns=["i", "j", "total"])


def _collected(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j): one row per dimension or pair of dimensions."""
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    return {(r["i"], r["j"]): int(r["total"]) for r in sums.collect()}


def dimension_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """(n, S): how many vectors, and the sum of each dimension."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], int] = {}
        for _, x in _blocks(batches):
            totals[-1, 0] = totals.get((-1, 0), 0) + len(x)
            for i, s in enumerate(x.sum(0).tolist()):
                totals[i, i] = totals.get((i, i), 0) + s
        yield _added(totals)

    got = _collected(rows.mapInPandas(run, "i int, j int, total string"))
    n = got.pop((-1, 0), 0)
    return n, [got[i, i] for i in range(len(got))]


def _squares(y: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squares of each column (i, i) and of each sum of two columns (i, j), i < j."""
    if int(np.abs(y).max()) ** 2 * 4 * len(y) >= _SAFE:
        y = y.astype(object)
    out = {}
    for i in range(y.shape[1]):
        out[i, i] = int((y[:, i] * y[:, i]).sum())
        both = y[:, i:i + 1] + y[:, i + 1:]
        out.update(((i, i + 1 + j), int(s)) for j, s in enumerate((both * both).sum(0).tolist()))
    return out


def pair_squares(rows: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums over all rows of (n x_i - S_i)^2 at (i, i) and of (n x_i + n x_j - S_i - S_j)^2 at (i, j)."""
    near = [(2 * s + n) // (2 * n) for s in sums]  # the whole number next to each mean
    rest = [s - n * c for s, c in zip(sums, near)]  # sum of x - near, at most n / 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], int] = {}
        at = np.array(near, dtype=np.int64)
        for _, x in _blocks(batches):
            for k, s in _squares(x - at).items():
                totals[k] = totals.get(k, 0) + s
        yield _added(totals)

    got = _collected(rows.mapInPandas(run, "i int, j int, total string"))
    # With y centred at the whole number and r its sum: sum (n y - r)^2 = n^2 sum y^2 - n r^2.
    shift = {(i, j): rest[i] if i == j else rest[i] + rest[j] for i, j in got}
    return {k: n * n * q - n * shift[k] ** 2 for k, q in got.items()}


def covariance(n: int, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix (divisor n): every entry is the double next to the exact value."""
    d = max(i for i, _ in squares) + 1
    out, scale = np.zeros((d, d)), n ** 3
    for (i, j), q in squares.items():
        twice = 2 * q if i == j else q - squares[i, i] - squares[j, j]
        out[i, j] = out[j, i] = float(Fraction(twice, 2 * scale))
    return out


def components(cov: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns); each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values, vectors * sign


class Whitener:
    """Centres integer vectors and projects them on scaled components."""

    def __init__(self, n: int, sums: list[int], cov: np.ndarray, most: int = COMPONENTS):
        self.n, self.near = n, np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
        self.rest = np.array([s - n * int(c) for s, c in zip(sums, self.near)], dtype=np.int64)
        self.values, vectors = components(cov, most)
        trace = float(np.trace(cov))
        self.explained = self.values / trace if trace > 0 else np.zeros(len(self.values))
        self.good = (self.values > FLAT * max(self.values[0], 0)) & (self.values > 0)
        self.matrix = np.where(self.good, vectors / np.sqrt(np.where(self.good, self.values, 1)), np.nan)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.near) - self.rest / self.n) @ self.matrix

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        y = x - self.near
        if (int(np.abs(y).max()) + 1) ** 2 * self.n ** 2 * y.shape[1] >= _SAFE:
            y = y.astype(object)
        z = y * self.n - self.rest
        return [d if d < 1 << 63 else None for d in map(int, (z * z).sum(1).tolist())]


def fit(rows: DataFrame, most: int = COMPONENTS) -> Whitener | None:
    """The whitener of all ``integers`` rows; None without rows."""
    n, sums = dimension_sums(rows)
    return Whitener(n, sums, covariance(n, pair_squares(rows, n, sums)), most) if n else None


def identity_error(rows: DataFrame, by: Whitener) -> float | None:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    good, n = np.nonzero(by.good)[0], by.n
    if not len(good):
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, products = np.zeros(len(good)), np.zeros((len(good), len(good)))
        for _, x in _blocks(batches):
            w = by.whiten(x)[:, good]
            total += w.sum(0)
            products += w.T @ w
        i, j = np.triu_indices(len(good))
        yield pd.DataFrame({"i": np.r_[i, np.arange(len(good))], "j": np.r_[j, np.full(len(good), -1)],
                            "total": np.r_[products[i, j], total]})

    sums = rows.mapInPandas(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t"))
    got = {(r["i"], r["j"]): r["t"] for r in sums.collect()}  # one row per pair of components
    mean = [got[i, -1] / n for i in range(len(good))]
    return max(abs(t / n - mean[i] * mean[j] - (i == j)) for (i, j), t in got.items() if j >= 0)


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = integers(vectors, id_col, vec_col)
    by = fit(rows, most)
    kind = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if by is None:
        return vectors.sparkSession.createDataFrame([], kind)
    error = identity_error(rows, by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _blocks(batches):
            w = by.whiten(x)
            k = w.shape[1]
            white = pd.array(w.ravel(), dtype="Float64")
            white[np.isnan(w.ravel())] = pd.NA
            yield pd.DataFrame({
                "id": part["id"].astype("Int64").repeat(k).reset_index(drop=True),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), "n": by.n,
                "deviation": pd.array(by.deviation(x), dtype="Int64").repeat(k), "whitened": white,
                "explained": np.tile(by.explained, len(x)),
                "identity_error": pd.array([error], dtype="Float64").repeat(len(x) * k)})

    return rows.mapInPandas(run, kind)
