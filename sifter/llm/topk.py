"""Exact top-k inner products by Fagin's threshold algorithm.

Each shard of vectors keeps one sorted list per dimension.  Reading the lists
to a depth s bounds every unseen vector by
``T(s) = sum_d q_d * (value at depth s of list d, from the top if q_d > 0, else from the bottom)``;
a query stops at the first depth whose bound is below its k-th best score.
Vectors are grouped around sampled ones, and a shard has vectors of one group,
so that its bounds are close.  A query's k-th score in the sample is a lower
bound of its k-th score in the table; with it, and with what the task's earlier
shards gave, a shard whose first entries are bounded below it is left at once.
Queries whose lists would be read to more entries than the shard has vectors
share one matrix product.

Scores are whole numbers, so results are exact; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize

K = 20
SCALE = 64
SHARD_ROWS = 8192
TASK_SHARDS = 16  # shards' worth of vectors in a cell, at most
GROUP_ROWS = 512  # vectors around a sampled one, about
GROUPS = 1024
SAMPLE = 4096
QUERY_BLOCK_BYTES = 16 * 1024 * 1024
LEAST = np.iinfo(np.int64).min
EXACT = float(1 << 53)  # whole numbers below it are exact as doubles

HIT_SCHEMA = "query_id long, vec_id array<long>, score array<long>, shards long, stopped long"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component; rows with a NULL id, vector or component, or a component that is
    not finite, are left out."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda c: c)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(fine)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")))


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows; a shorter one is filled with zeros."""
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(lists), dims), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = lists.flatten().to_numpy()
    inside = col < dims
    out[row[inside], col[inside]] = values[inside]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: by doubles while they are exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        """``floor``: a score that each query's k-th best is known to reach."""
        self.k = k
        self.score = [np.zeros(0, np.int64)] * n
        self.id = [np.zeros(0, np.int64)] * n
        self.kth = np.full(n, LEAST) if floor is None else floor.copy()

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:  # what is below the k-th of these cannot count
            some = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids = scores[some], ids[some]
        scores, ids = np.concatenate([self.score[q], scores]), np.concatenate([self.id[q], ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.score[q], self.id[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.kth[q] = max(self.kth[q], scores[order[-1]])


def search_shard(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> np.ndarray:
    """Threshold algorithm of all queries over one shard: which of them a bound stopped."""
    n, dims = x.shape
    order = np.argsort(-x, axis=0, kind="stable")  # list of each dimension, largest first
    values = np.take_along_axis(x, order, axis=0)
    depths = np.unique(np.minimum(2 ** np.arange(int(np.log2(n)) + 2) - 1, n - 1))
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # bound on vectors unseen after reading entries 0..depth of each list
    bound = _products(up, values[depths]) + _products(down, values[n - 1 - depths])
    whole = []
    stopped = bound[:, 0] < best.kth  # the first entries bound all vectors
    for q in np.flatnonzero(~stopped).tolist():
        stop = np.flatnonzero(bound[q] < best.kth[q])
        used = np.flatnonzero(queries[q])
        read = int(depths[stop[0]]) + 1 if len(stop) else n
        if len(used) and read * len(used) >= n or not len(stop):
            whole.append(q)
            continue
        seen = np.zeros(n, bool)
        at = 0
        for k, depth in enumerate(depths.tolist()):
            lists = [order[at:depth + 1, used[queries[q, used] > 0]], order[n - 1 - depth:n - at, used[queries[q, used] < 0]]]
            fresh = np.unique(np.concatenate([p.ravel() for p in lists]))
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            fresh = fresh[ids[fresh] != query_ids[q]]
            if len(fresh):
                best.add(q, _products(queries[q:q + 1], x[fresh])[0], ids[fresh])
            if bound[q, k] < best.kth[q]:
                stopped[q] = True
                break
            at = depth + 1
    for first in range(0, len(whole), 512):
        some = np.array(whole[first:first + 512])
        scores = _products(queries[some], x)
        for q, row in zip(some.tolist(), scores):
            other = ids != query_ids[q]
            fit = other & (row >= best.kth[q])
            if fit.any():
                best.add(q, row[fit], ids[fit])
    return stopped


def floors(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among some of the vectors; LEAST with fewer than ``k`` besides its own."""
    out = np.full(len(queries), LEAST)
    for first in range(0, len(queries), 512):
        scores = _products(queries[first:first + 512], x)
        scores[query_ids[first:first + 512, None] == ids] = LEAST
        if len(ids) >= k:
            out[first:first + 512] = np.partition(scores, -k, axis=1)[:, -k]
    return out


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The number of the pivot at the least distance, by doubles: it groups only."""
    p = pivots.astype(np.float64)
    return np.argmax(x.astype(np.float64) @ p.T - (p ** 2).sum(axis=1) / 2, axis=1)


def deal_groups(sizes: dict[int, int], room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Cells of about ``room`` vectors: each group's first cell, how many cells it fills, and the number of all cells.

    Small groups that follow each other share a cell; a large one is split.
    """
    start, parts = np.zeros(max(sizes, default=0) + 1, np.int64), np.ones(max(sizes, default=0) + 1, np.int64)
    cell, used = 0, 0
    for group in sorted(sizes):
        if used and used + sizes[group] > room:
            cell, used = cell + 1, 0
        start[group], parts[group] = cell, max(1, -(-sizes[group] // room))
        if parts[group] > 1:
            cell, used = cell + int(parts[group]), 0
        else:
            used += sizes[group]
    return start, parts, cell + (1 if used else 0)


def task_hits(vectors: DataFrame, queries: str, k: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """A row per query and cell: its best there, the shards it met and those that a bound stopped.

    Queries are numbered in blocks and vectors in cells by Spark; a task gets
    one block and one cell, so the driver holds only their numbers.
    """
    spark = vectors.sparkSession
    whole = materialize(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    rows, dims, asking = whole.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if(F.expr(queries))).first()
    dims = dims or 0
    room = max(1, QUERY_BLOCK_BYTES // (8 * max(dims, 1)))
    some = whole.orderBy(F.xxhash64("id", "v"), "id").limit(min(SAMPLE, room)).collect()
    sample = np.array([r["id"] for r in some], np.int64), _matrix(pa.array([r["v"] for r in some], pa.list_(pa.int64())), dims)
    pivots = np.unique(sample[1][:max(1, min(GROUPS, rows // GROUP_ROWS))], axis=0)
    given = spark.sparkContext.broadcast((sample, pivots))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = nearest(_matrix(batch.column(1), dims), given.value[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], ["id", "v", "near"])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = floors(batch.column(0).to_numpy(), _matrix(batch.column(1), dims), *given.value[0], k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], ["id", "v", "floor"])

    grouped = materialize(whole.mapInArrow(group, "id long, v array<long>, near int"), "vectors-grouped")
    sizes = {r["near"]: r["n"] for r in grouped.groupBy("near").agg(F.count(F.lit(1)).alias("n")).collect()}  # GROUPS at most
    start, parts, cells = deal_groups(sizes, min(SHARD_ROWS * TASK_SHARDS, -(-rows // (2 * spark.sparkContext.defaultParallelism))))
    blocks = max(1, -(-asking // room))

    def at(values: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("near") + 1)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)))

    candidates = (grouped.withColumn("cell", (at(start) + F.pmod(F.monotonically_increasing_id(), at(parts))).cast("int"))
                  .withColumn("block", every(blocks)))
    asked = (grouped.filter(queries).select("id", "v").distinct().mapInArrow(bound, "id long, v array<long>, floor long")
             .withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).withColumn("cell", every(cells)))

    def search(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        def column(table: pa.Table, name: str) -> pa.Array:
            return table.column(name).combine_chunks()

        query_ids, q = column(asked, "id").to_numpy(), _matrix(column(asked, "v"), dims)
        best, shards, stopped = Best(len(q), k, column(asked, "floor").to_numpy()), 0, np.zeros(len(q), np.int64)
        ids, near, x = column(vectors, "id").to_numpy(), column(vectors, "near").to_numpy(), column(vectors, "v")
        order = np.lexsort((ids, near))
        cuts = [0, *(np.flatnonzero(np.diff(near[order])) + 1).tolist(), len(order)]
        for a, b in zip(cuts[:-1], cuts[1:]) if len(q) else ():
            for first in range(a, b, SHARD_ROWS):
                mine = order[first:min(first + SHARD_ROWS, b)]
                stopped += search_shard(ids[mine], _matrix(x.take(pa.array(mine)), dims), query_ids, q, best)
                shards += 1
        return pa.table([pa.array(query_ids), pa.array(best.id, pa.list_(pa.int64())), pa.array(best.score, pa.list_(pa.int64())),
                         pa.array(np.full(len(q), shards)), pa.array(stopped)], ["query_id", "vec_id", "score", "shards", "stopped"])

    return candidates.groupBy("block", "cell").cogroup(asked.groupBy("block", "cell")).applyInArrow(search, HIT_SCHEMA)


def top_k(vectors: DataFrame, queries: str = "id % 20 = 0", k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best of all other rows, by whole inner product.

    ``queries``: which ids are queries.  A query's own row is the one with its
    id; repeated query rows ask once, repeated candidates each take a place.
    A vector shorter than the longest is filled with zeros.  Fewer than ``k``
    candidates give them all; an empty table or one without queries gives no
    rows.

    The queries are dealt into blocks of about 16 MB, and each block meets all cells
    of candidates that a bound does not rule out; a task gives at most ``k`` rows per
    query, and a ranking window cuts them to ``k``.
    """
    hits = task_hits(vectors, queries, k, scale, id_col, vector_col)
    each = hits.select("query_id", F.explode(F.arrays_zip("vec_id", "score")).alias("h")).select("query_id", "h.vec_id", "h.score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ship_by_value(__name__)
