"""Points in intervals, by a sweep over range-dealt points.

The points are range-dealt by (time, id) into parts of about ``PART_ROWS``
rows, so a hot hour, or a single hot millisecond, is as many parts as it has
rows for.  An interval goes to the parts whose time span it meets: at most one
row per part, whatever its length.  In a part the intervals are held and the
points stream by in time order; each interval finds its points of a batch by two
binary searches, so the work is the rows, a logarithm, and the pairs found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.session import write_and_read

PART_ROWS = 200_000
PAIR_ROWS = 200_000  # pairs given out at a time, about


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (_part, _kind, _t): a part's intervals (_kind 0), then its points."""
    part, starts, ends = None, [], []
    none = np.zeros(0, np.int64)
    low, high = none, none
    for pdf in batches:
        if not len(pdf):
            continue
        parts = pdf["_part"].to_numpy()
        cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(pdf)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if parts[a] != part:
                part, starts, ends, low, high = parts[a], [], [], none, none
            rows = pdf.iloc[a:b]
            held = rows["_kind"].to_numpy() == 0
            if held.any():
                starts.append(rows["_t"].to_numpy()[held])
                ends.append(rows["_end"].to_numpy()[held].astype(np.int64))
                low, high = np.concatenate(starts), np.concatenate(ends)
            points = rows[~held]
            if not len(points) or not len(low):
                continue
            t = points["_t"].to_numpy()
            first, last = np.searchsorted(t, low, "left"), np.searchsorted(t, high, "left")
            n = np.maximum(last - first, 0)
            some = np.flatnonzero(n)
            upto = np.cumsum(n[some])
            while len(some):  # as many intervals as give about PAIR_ROWS pairs, one at least
                take = max(1, int(np.searchsorted(upto, PAIR_ROWS, "right")))
                now, some = some[:take], some[take:]
                upto = upto[take:] - (upto[take - 1] if take <= len(upto) else 0)
                count = n[now]
                at = np.repeat(first[now] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                yield pd.DataFrame({"_id": points["_id"].to_numpy()[at], "_t": t[at], "_start": np.repeat(low[now], count),
                                    "_end": np.repeat(high[now], count)})


def points_in_intervals(points: DataFrame, intervals: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(_id, _t, _start, _end) for each of ``points`` (_id, _t) in each of ``intervals`` (_start, _end): _start <= _t < _end.

    Repeated points and repeated intervals each count; rows with a NULL time or
    bound meet nothing, nor does an interval that is empty.  Building the frame
    writes the points with their part once; the parts' spans (a row per part)
    come to the driver.
    """
    ship_by_value(__name__)
    spark = points.sparkSession
    kinds = dict(points.dtypes)
    slim = points.select("_id", F.col("_t").cast("bigint").alias("_t")).where("_t IS NOT NULL")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-slim.count() // part_rows))
    dealt = write_and_read(slim.repartitionByRange(parts, "_t", "_id").withColumn("_part", F.spark_partition_id()), "points")
    spans = [tuple(r) for r in dealt.groupBy("_part").agg(F.min("_t"), F.max("_t")).orderBy("_part").collect()]  # a row per part
    listed = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b")) for p, a, b in spans])
    met = F.filter(listed, lambda s: (s["a"] < F.col("_end")) & (s["b"] >= F.col("_start"))) if spans \
        else F.array().cast("array<struct<p:int,a:bigint,b:bigint>>")
    held = intervals.select(F.col("_start").cast("bigint").alias("_start"), F.col("_end").cast("bigint").alias("_end")) \
        .where("_start < _end").select("_start", "_end", F.explode(met).alias("_s")).select(
            F.lit(0).cast(kinds["_id"]).alias("_id"), F.col("_start").alias("_t"), "_end", F.col("_s.p").alias("_part"), F.lit(0).alias("_kind"))
    # no NULLs: whole numbers stay whole on their way through pandas
    rows = held.unionByName(dealt.select("_id", "_t", F.lit(0).cast("bigint").alias("_end"), "_part", F.lit(1).alias("_kind")))
    return rows.repartition(parts, "_part").sortWithinPartitions("_part", "_kind", "_t", "_id") \
        .mapInPandas(_sweep, f"_id {kinds['_id']}, _t bigint, _start bigint, _end bigint")
