"""Operator 13: centroid clustering of integer vectors, nearest centroid by the threshold algorithm.

For every dimension the centroids are sorted by their component. A vector walks
these lists outward from its own value, one step in every list at a time. A
centroid that is met gets its exact squared distance; one that no list has met
yet is at least as far off in every dimension as that list's frontier. So the
sum of the squared frontier distances bounds all of them, and the walk stops
once that sum strictly exceeds the best exact distance (strictly, so that an
equally near centroid with a smaller number is still met).

Rounds run as one pass over the vectors each: tasks assign their rows and hand
on one partial sum per centroid, which are added up in a grouping. The driver
holds the centroids alone (``k`` times the dimensions, whatever the corpus).

Results for odd rows: a vector that is null, of another length, or that holds a
null or non-finite entry is left out. A component beyond +-2^27 is held at that
bound, so that squared distances fit a long. A null id has no hash: its row
starts a centroid only after all others; it is assigned like any row. Repeated
rows count as often as they come; rows with one id start centroids in the order
of their components. With fewer than ``k`` vectors each starts a centroid; an
empty table gives an empty table. Further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialise

K = 40
DIMENSIONS = 64
ROUNDS = 5
SCALE = 256
#: Seed of the starting hash, the part before the colon.
SEED = 2
#: Components are held within plus or minus this.
BOUND = 1 << 27
#: Vectors that a task walks at a time.
BLOCK = 1024
_FAR = 1 << 62


def integers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """id, x (longs): the usable vectors."""
    v = F.col(vec_col).cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(BOUND))), F.lit(-float(BOUND)))))
    return vectors.where(F.col(vec_col).isNotNull() & (F.size(vec_col) == dimensions)).where(~odd).select(
        F.col(id_col).cast("long").alias("id"), held.cast("array<long>").alias("x"))


def starts(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors of the smallest hashes (a top-k of fixed size)."""
    first = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)).orderBy(
        F.col("h").asc_nulls_last(), "x").limit(k)
    return [list(r["x"]) for r in first.select("x").collect()]


class Walker:
    """Nearest of some centroids, by walking their per-dimension lists."""

    def __init__(self, centroids: list[list[int]]):
        self.c = np.array(centroids, dtype=np.int64)
        self.k, self.d = self.c.shape
        order = np.argsort(self.c, axis=0, kind="stable")
        self.values = np.take_along_axis(self.c, order, 0)
        edge = np.full((1, self.d), _FAR)
        self.padded = np.concatenate([-edge, self.values, edge]).ravel()
        none = np.full((1, self.d), self.k)
        self.order = np.concatenate([none, order, none]).ravel()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row; ties: the smaller number."""
        number, best = np.zeros(len(x), np.int64), np.full(len(x), _FAR)
        column = np.arange(self.d)
        right = np.stack([np.searchsorted(self.values[:, j], x[:, j]) for j in column], 1) + 1
        left, rows = right - 1, np.arange(len(x))
        exact = np.full((len(x), self.k), _FAR)
        for _ in range(self.k):
            at_left, at_right = left * self.d + column, right * self.d + column
            down, up = x - self.padded[at_left], self.padded[at_right] - x
            frontier = np.minimum(down, up)
            going = (frontier * frontier).sum(1) <= best[rows]
            if not going.all():
                x, left, right, rows, exact, down, up, at_left, at_right = (
                    a[going] for a in (x, left, right, rows, exact, down, up, at_left, at_right))
                if not len(rows):
                    break
            lower = down <= up
            met = np.zeros((len(x), self.k + 1), bool)
            met[np.arange(len(x))[:, None], np.where(lower, self.order[at_left], self.order[at_right])] = True
            r, c = np.nonzero(met[:, :self.k] & (exact == _FAR))
            gap = x[r] - self.c[c]
            exact[r, c] = (gap * gap).sum(1)
            number[rows], best[rows] = exact.argmin(1), exact.min(1)
            left, right = left - lower, right + ~lower
        return number, best


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for b in batches:
        for k in range(0, len(b), BLOCK):
            part = b.iloc[k:k + BLOCK]
            yield part, np.array(part["x"].tolist(), dtype=np.int64)


def assign(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``integers`` rows -> id, cluster, distance."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker = Walker(centroids)
        for part, x in _blocks(batches):
            number, distance = walker.nearest(x)
            yield pd.DataFrame({"id": part["id"].astype("Int64"), "cluster": number.astype(np.int32),
                                "distance": distance})

    return vectors.mapInPandas(run, "id long, cluster int, distance long")


def means(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the exact means, an empty one as it was."""
    width = len(centroids[0])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walker, n = Walker(centroids), np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), width), np.int64)
        for _, x in _blocks(batches):
            number, _d = walker.nearest(x)
            np.add.at(total, number, x)
            n += np.bincount(number, minlength=len(n))
        there = np.nonzero(n)[0]
        if len(there):
            yield pd.DataFrame({"cluster": there.astype(np.int32), "n": n[there], "total": [total[c] for c in there]})

    parts = vectors.mapInPandas(run, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.col("total")[j]) for j in range(width)]).alias("total"))
    out = list(centroids)
    for r in sums.collect():  # one row per centroid
        out[r["cluster"]] = [t // r["n"] for t in r["total"]]
    return out


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> list[list[int]]:
    """Centroids of ``integers`` rows after ``rounds`` rounds; none of an empty table."""
    centroids = starts(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = means(vectors, centroids)
    return centroids


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id",
            vec_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid: a row for each usable vector."""
    spark, ints = vectors.sparkSession, integers(vectors, id_col, vec_col, dimensions)
    centroids = fit(ints, k, rounds)
    rows = materialise(assign(ints, centroids) if centroids else spark.createDataFrame(
        [], "id long, cluster int, distance long"), "centroid-clusters")
    own = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row per centroid
    all_ = own.agg(F.sum("cluster_inertia")).scalar()
    named = spark.createDataFrame(list(enumerate(centroids)), "cluster int, centroid array<long>")
    return rows.join(F.broadcast(own), "cluster").withColumn("inertia", all_).join(F.broadcast(named), "cluster")


def digest_col(centroid: str = "centroid"):
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
