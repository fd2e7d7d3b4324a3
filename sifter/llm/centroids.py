"""Centroid clustering with nearest centroids found by a bisector tournament.

For centroids a (the smaller number) and b, the plane half-way between them has
the integer normal ``2 (b - a)`` and threshold ``|b|^2 - |a|^2``: a vector x is
nearer to b exactly when ``x . normal > threshold``, and zero favours a.  A
vector's nearest centroid is the winner of k - 1 such sign tests in rounds of
neighbours: (0, 1), (2, 3), ... first, then their winners.  (distance, number)
is a total order, so the winner is the first of the nearest, and only its
distance is computed.

All arithmetic is on whole numbers: vectors are scaled and floored, centroids
are floored means.  Products are taken as doubles while every sum stays below
2^53, else as 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize

K = 8
DIMS = 64
SCALE = 1024
ROUNDS = 10
SEED = 3
MAX_COMPONENT = 1 << 27  # of a scaled component: squared distances of 64 of them fit a long
EXACT = float(1 << 53)
BATCH_ROWS = 8192


class Tournament:
    """Bisectors of all centroid pairs, and the nearest centroid of many vectors at once."""

    def __init__(self, centroids: np.ndarray):
        """``centroids``: (k, dims) whole numbers, k >= 1."""
        self.c = centroids.astype(np.int64)
        self.norm = (self.c ** 2).sum(axis=1)
        a, b = np.triu_indices(len(self.c), 1)
        self.normal = np.zeros((len(self.c), len(self.c), self.c.shape[1]), np.int64)
        self.normal[a, b] = 2 * (self.c[b] - self.c[a])
        self.threshold = np.zeros((len(self.c),) * 2, np.int64)
        self.threshold[a, b] = self.norm[b] - self.norm[a]
        self.most = int(np.abs(self.c).max(initial=0))

    def _number(self, x: np.ndarray) -> type:
        """The type in which every product and sum with these vectors is exact."""
        most = max(int(np.abs(x).max(initial=0)), self.most)
        return np.float64 if 4.0 * most * most * max(x.shape[1], 1) < EXACT else np.int64

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of each row's nearest centroid; ties go to the smaller number."""
        kind = self._number(x)
        v, normal, threshold = x.astype(kind), self.normal.astype(kind), self.threshold.astype(kind)
        left = [np.full(len(x), i) for i in range(len(self.c))]
        while len(left) > 1:
            pairs = zip(left[::2], left[1::2])
            left = [self._play(v, a, b, normal, threshold) for a, b in pairs] + left[len(left) & ~1:]
        return left[0]

    @staticmethod
    def _play(v: np.ndarray, a: np.ndarray, b: np.ndarray, normal: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Who wins of a and b (a < b in every row): one sign test a row."""
        out = a.copy()
        pair = a * len(normal) + b
        for p in np.unique(pair).tolist():
            i, j = divmod(p, len(normal))
            rows = np.flatnonzero(pair == p)
            out[rows[v[rows] @ normal[i, j] > threshold[i, j]]] = j
        return out

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        """The squared distance of each row to its winner, exact."""
        gap = x.astype(np.int64) - self.c[winner]
        return (gap * gap).sum(axis=1)


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component of the vectors with ``dims`` components, none NULL or not finite."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) <= MAX_COMPONENT, F.floor(c * scale).cast("int")))
    return (vectors.filter(F.col(vector_col).isNotNull()).filter(F.size(vector_col) == dims).filter(fine)
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v")))


def _rows(lists: pa.ListArray, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), dims)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(first, BATCH_ROWS)


def _sums(whole: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int]]]:
    """Per centroid with vectors: how many, and their componentwise sum.

    A task gives a row per centroid, and those are summed before they are
    collected: k rows of dims + 1 numbers, whatever the table.
    """
    k, dims = centroids.shape
    tournament = Tournament(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in _pieces(batches):
            x = _rows(batch.column(0), dims)
            winner = tournament.winners(x)
            n += np.bincount(winner, minlength=k)
            for c in np.unique(winner).tolist():
                total[c] += x[winner == c].sum(axis=0, dtype=np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = whole.select("v").mapInArrow(run, "cluster long, n long, total array<long>")
    each = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    return [(r[0], [int(s) for s in r[1:]]) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *each).collect()]


def fit_centroids(whole: DataFrame, dims: int = DIMS, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """(k, dims) centroids after ``rounds`` rounds over the table (id, v); fewer when it has fewer rows.

    They start as the vectors whose ids hash lowest; rows with the same id are
    taken in the order of their vectors, and rows without an id come last.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = whole.select(key.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    c = np.array([r["v"] for r in first], np.int64).reshape(len(first), dims)
    for _ in range(rounds if len(c) else 0):
        after = c.copy()
        for cluster, (n, *total) in _sums(whole, c):
            after[cluster] = [s // n for s in total]
        if (after == c).all():  # every later round would repeat this one
            break
        c = after
    return c


def assign(whole: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every row of (id, v)."""
    dims = centroids.shape[1]
    tournament = Tournament(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            x = _rows(batch.column(1), dims)
            winner = tournament.winners(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(winner.astype(np.int32)), pa.array(tournament.distances(x, winner))],
                ["id", "cluster", "distance"])

    return whole.mapInArrow(run, "id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, k: int = K,
                    scale: int = SCALE, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector.

    Kept are vectors with exactly ``dims`` components, none NULL or not finite;
    repeated rows count each, a NULL id is kept and never starts a centroid
    while others can.  Fewer than ``k`` vectors make as many centroids, an empty
    table gives no rows.  A centroid that gets no vector stays where it is.  A
    component beyond 131,072 in size is an error, because its distance might not
    fit a long; so is an inertia that does not.

    The whole-number vectors are written once; each round is one pass over them
    that brings k rows of sums to the driver.  Building the frame runs the rounds.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    whole = materialize(kept_vectors(vectors, id_col, vector_col, dims, scale), "whole-vectors")
    if whole.filter(F.exists("v", lambda c: c.isNull())).take(1):
        raise ValueError(f"a component is beyond {MAX_COMPONENT / scale:.0f}: its distance might not fit a long")
    c = fit_centroids(whole, dims, k, rounds, seed)
    if not len(c):
        return spark.createDataFrame([], schema)
    placed = materialize(assign(whole, c), "placed")
    inertia = {r[0]: int(r[1]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    if sum(inertia.values()) >= 1 << 63:
        raise ValueError("the inertia does not fit a long")
    names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    each = spark.createDataFrame([(i, inertia.get(i, 0), names[i]) for i in range(len(c))],
                                 "cluster int, cluster_inertia long, centroid_sha256 string")
    return (placed.join(F.broadcast(each), "cluster")  # k rows
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia",
                    F.lit(sum(inertia.values())).cast("long").alias("inertia"), "centroid_sha256"))


ship_by_value(__name__)
