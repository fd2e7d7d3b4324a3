"""Keyed running aggregates that do not put one key's rows in one task.

``sum(x) over (partition by key order by t)`` hash-partitions on ``key``
alone, so a key holding a third of the rows makes one task do a third of
the work.  ``running_agg`` handles the two kinds of keys apart:

* **heavy keys** are found from a sample (:func:`heavy_keys`): only keys
  estimated to hold about a million rows or more qualify, so there are at
  most rows / 1e6 of them (a proven bound; the list is broadcast).  Their rows are cut along the
  order axis into cells (``cell``: non-decreasing along the order, e.g.
  ``floor(t / width)``):

  1. per (key, cell), the running value inside the cell; the shuffle is
     spread over keys x cells, so a hot key spans many tasks;
  2. per (key, cell) totals by a partial (map-side) aggregate, then per key
     the total of all earlier cells: a window over that small table;
  3. an equi-join of 2 onto 1 on (key, cell).

* **all other keys** take one plain window partitioned by key: each holds
  too few rows to burden a task, and no cell-total table or join is built
  for the long tail.

Both paths are exact; detection only decides speed.  The input is read by
the sample and by both paths, so callers pass materialised or cheap input
(the flagship passes checkpointed slim rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "max": F.max, "min": F.min}

# Defaults of the heavy-key test: a key is split when it holds about a
# million rows or more (smaller keys sort fine in one task).  At most
# rows / MIN_ROWS keys can qualify, e.g. 40,000 keys (a few hundred KB) for
# 4e10 rows: the broadcast is bounded by construction.
SAMPLE_FRACTION = 0.01
MIN_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: Sequence[str], *, sample_fraction: float | None = None,
               min_rows: int | None = None, seed: int = 17) -> DataFrame:
    """Keys estimated (from a sample) to hold at least ``min_rows`` rows.

    One job: the sample is counted per key on the executors and only the
    qualifying keys (at most ``rows / min_rows``) come back, as a small
    DataFrame to broadcast.
    """
    sample_fraction = SAMPLE_FRACTION if sample_fraction is None else sample_fraction
    min_rows = MIN_ROWS if min_rows is None else min_rows
    keys = list(keys)
    counts = df.sample(fraction=sample_fraction, seed=seed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    threshold = max(min_rows * sample_fraction, 1)
    rows = counts.where(F.col("_n") >= threshold).select(*keys).collect()
    schema = df.select(*keys).schema
    return df.sparkSession.createDataFrame([tuple(r) for r in rows], schema)


def no_heavy_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An empty heavy-key list: every key takes the plain window (bounded inputs, e.g. one micro-batch)."""
    return df.sparkSession.createDataFrame([], df.select(*keys).schema)


def running_agg(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str,
                out: str, cell: Column, *, fn: str = "sum", inclusive: bool = False,
                hot: DataFrame | None = None) -> DataFrame:
    """Adds ``out`` = fn(value) over the key's rows before (``inclusive``: up to) each row.

    NULL when there is no such row (callers coalesce).  ``cell`` must be
    non-decreasing along ``order`` within a key.  ``hot``: the heavy keys,
    when the caller already knows them (else they are detected).
    """
    keys = list(keys)
    val = F.col(value) if isinstance(value, str) else value
    x = df.withColumn("_val", val)
    if hot is None:
        hot = heavy_keys(df, keys)
    if not hot.take(1):
        return _plain(x, keys, order, out, fn, inclusive).select(*df.columns, out)
    hot_b = F.broadcast(hot)  # at most rows / MIN_ROWS keys
    cold = x.join(hot_b, keys, "left_anti")
    heavy = x.join(hot_b, keys, "left_semi")
    return _plain(cold, keys, order, out, fn, inclusive).select(*df.columns, out).unionByName(
        _celled(heavy, keys, order, out, cell, fn, inclusive).select(*df.columns, out))


def _frame(inclusive: bool):
    return (Window.unboundedPreceding, 0 if inclusive else -1)


def _plain(x: DataFrame, keys, order, out, fn, inclusive) -> DataFrame:
    agg = _AGGS[fn]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order]).rowsBetween(*_frame(inclusive))
    return x.withColumn(out, agg("_val").over(w))


def _celled(x: DataFrame, keys, order, out, cell: Column, fn, inclusive) -> DataFrame:
    agg = _AGGS[fn]
    x = x.withColumn("_cell", cell)
    inside = Window.partitionBy(*keys, "_cell").orderBy(*[F.col(c) for c in order]) \
        .rowsBetween(*_frame(inclusive))
    within = x.withColumn("_in", agg("_val").over(inside))
    # Cell totals straight from the input: partial aggregation on every task,
    # so only (key, cell) partial results cross the network.
    per_cell = x.groupBy(*keys, "_cell").agg(agg("_val").alias("_cv"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_cell").alias("_o_cell"),
                              agg("_cv").over(earlier).alias("_off"))
    # null-safe: a NULL order value (e.g. a task without a time) is a cell like any other
    cond = [within[k].eqNullSafe(offsets[f"_o_{k}"]) for k in keys] + \
        [within["_cell"].eqNullSafe(offsets["_o_cell"])]
    j = within.join(offsets, cond)
    if fn == "sum":
        combined = F.when(F.col("_off").isNull() & F.col("_in").isNull(), F.lit(None)) \
            .otherwise(F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.col("_in"), F.lit(0)))
    elif fn == "max":
        combined = F.greatest(F.col("_off"), F.col("_in"))
    else:
        combined = F.least(F.col("_off"), F.col("_in"))
    return j.withColumn(out, combined)
