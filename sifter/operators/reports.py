"""Operational reports.

Each report is a hash aggregate with map-side partial aggregation, plus
at most a window over an already-aggregated (small) table.  Global orders
(percentiles, running backlog) are computed with a two-level scheme so no
single task receives the raw rows.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sifter import constants as K
from sifter.operators import intervals
from sifter.session import write_and_read

SKETCH_ACCURACY = 10_000  # a sketch's rank error is at most one part in this many
SKETCH_MARGIN = 3 / SKETCH_ACCURACY  # on both sides of a wanted rank


# --------------------------------------------------------------------------- A5
def load_report(requests: DataFrame) -> DataFrame:
    """A5: total, accepted (202), rate-limited (429), failed (other), accepted/s, max latency of accepted.

    ``accepted_per_sec`` divides by the span of the log (last - first request).
    """
    acc = F.col("http_status") == 202
    return requests.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(acc).alias("accepted"),
        F.count_if(F.col("http_status") == 429).alias("ratelimited"),
        F.count_if(~F.col("http_status").isin(202, 429)).alias("failed"),
        (F.count_if(acc) * 1000.0 / F.greatest(F.max("t_ms") - F.min("t_ms"), F.lit(1)))
        .alias("accepted_per_sec"),
        F.max(F.when(acc, F.col("latency_ms"))).alias("max_latency_ms"),
    )


# --------------------------------------------------------------------------- A6
def _pname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


def rank_percentiles(df: DataFrame, col: str, ps: Sequence[float], by: Sequence[str] = (),
                     max_alias: str | None = None) -> DataFrame:
    """For each p, the element at 0-based rank ``min(int(p * n), n - 1)`` of the sorted values.

    Exact (not ``percentile_disc``, which rounds differently).  A mergeable
    sketch per group gives, for each p, two values that enclose the wanted
    rank; its rank error is at most n / SKETCH_ACCURACY.  A second pass counts:
    values between such a pair are kept, all others only add to the count of
    the pair below them.  So what is shuffled is the sketches and some
    thousandths of the values.  Whether each wanted rank fell on a kept value is
    checked; where one did not, all distinct values are ranked, as they are
    for a column that is no number.  NULL ``by`` values are a group.
    """
    by = list(by)
    rows = df.where(F.col(col).isNotNull()).select(*by, col)
    wanted = [(_pname(p), float(p)) for p in ps] + ([(max_alias, 1.0)] if max_alias else [])
    if wanted and isinstance(rows.schema[col].dataType, NumericType):
        found = _ranked(_near_ranks(rows, col, [p for _, p in wanted], by), col, wanted, by)
        found = write_and_read(found, "rank-values")
        missed = functools.reduce(Column.__or__, [F.col(name).isNull() for name, _ in wanted])
        if found.where(missed).isEmpty():
            return found
    counts = rows.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    return _ranked(counts.withColumn("_kept", F.col("_c")), col, wanted, by)


def _near_ranks(rows: DataFrame, col: str, ps: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by, value, _c, _kept): counts of the values near the ranks ``ps``; rows elsewhere count for the next kept value
    below (NULL: none), in ``_c`` only."""
    v = F.col(col)
    pairs = [(max(p - SKETCH_MARGIN, 0.0), min(p + SKETCH_MARGIN, 1.0)) if p < 1 else (1.0, 1.0) for p in ps]
    sketch = rows.groupBy(*by).agg(
        F.percentile_approx(v, [q for pair in pairs for q in pair], SKETCH_ACCURACY).alias("_at"))
    if by:
        sketch = write_and_read(sketch.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_at"), "rank-sketches")
        same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
        rows = rows.join(sketch, same)
        at = [F.col("_at")[i] for i in range(2 * len(pairs))]
    else:  # two values for each p
        values = sketch.first()["_at"] or [None] * 2 * len(pairs)
        at = [F.lit(x).cast(rows.schema[col].dataType) for x in values]
    kept = functools.reduce(Column.__or__, [(v >= low) & (v <= high) for low, high in zip(at[::2], at[1::2])])
    below = F.array_max(F.array(*[F.when(v > high, high) for high in at[1::2]]))
    return rows.groupBy(*by, F.when(kept, v).otherwise(below).alias(col)) \
        .agg(F.count(F.lit(1)).alias("_c"), F.count_if(kept).alias("_kept"))


def _ranked(counts: DataFrame, col: str, wanted: Sequence[tuple[str, float]], by: Sequence[str]) -> DataFrame:
    """The value at each wanted rank, NULL if it is none of the kept ones, from counts of values.

    The counts are range-dealt into bands of about equal depth, whatever the
    values' spread.  The few band totals tell which bands hold a wanted rank;
    only those are sorted.
    """
    counts = write_and_read(counts.repartitionByRange(*by, col).withColumn("_band", F.spark_partition_id()), "rank-bands")
    bands = counts.groupBy(*by, "_band").agg(F.sum("_c").alias("_bc"))
    earlier = Window.partitionBy(*by).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_band").alias("_b"), "_bc",
                         F.coalesce(F.sum("_bc").over(earlier), F.lit(0)).alias("_before"),
                         F.sum("_bc").over(Window.partitionBy(*by)).alias("_n"))
    ranks = [F.least(F.floor(F.lit(p) * F.col("_n")), F.col("_n") - 1) for _, p in wanted]
    inside_band = functools.reduce(Column.__or__, [
        (r >= F.col("_before")) & (r < F.col("_before") + F.col("_bc")) for r in ranks] or [F.col("_before") == 0])
    bands = bands.where(inside_band)
    same = counts["_band"] == bands["_b"]
    for c in by:
        same = same & counts[c].eqNullSafe(bands[f"_by_{c}"])
    inside = Window.partitionBy(*by, "_band").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    cells = counts.join(bands, same).withColumn("_first", F.col("_before") + F.sum("_c").over(inside) - F.col("_c"))
    return cells.groupBy(*by).agg(F.max("_n").alias("n"), *[
        F.max(F.when((r >= F.col("_first")) & (r < F.col("_first") + F.col("_kept")), F.col(col))).alias(name)
        for (name, _), r in zip(wanted, ranks)])


# --------------------------------------------------------------------------- A7
def moderation_latency(results: DataFrame, ps: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Reviewed - submitted per post, summarised by exact rank percentiles and max."""
    lat = results.select((F.col("reviewed_ms") - F.col("submitted_ms")).alias("latency_ms"))
    lat = write_and_read(lat, "latencies")  # read twice, and results may be dear to compute
    return rank_percentiles(lat, "latency_ms", ps, max_alias="max_latency_ms")


def latency_per_post(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """A7 (row form): post_id, latency_ms from task submit and result times."""
    t = tasks.select("post_id", F.unix_millis("submitted_at").alias("_s"))
    r = results.select(F.col("post_id").alias("_rp"), "reviewed_ms")
    return t.join(r, t["post_id"] == r["_rp"]).select("post_id", (F.col("reviewed_ms") - F.col("_s")).alias("latency_ms"))


# --------------------------------------------------------------------------- A8
def status_summary(results: DataFrame) -> DataFrame:
    """Verdict counts by status, reason and degraded."""
    return results.groupBy("status", "reason", "degraded").agg(F.count(F.lit(1)).alias("posts"))


def status_rollup(results: DataFrame) -> DataFrame:
    """A8 (report form): ROLLUP(status, reason); NULL marks a subtotal level."""
    return results.rollup("status", "reason").agg(F.count(F.lit(1)).alias("posts"))


# --------------------------------------------------------------------------- A9
def reconcile(posts: DataFrame, results: DataFrame) -> DataFrame:
    """Posts, result rows, distinct result post ids, duplicate results, posts with no result.

    One full outer join of post ids with per-post result counts, then one
    global aggregate (partial on every task).
    """
    p = posts.select("post_id", F.lit(1).alias("_p"))
    r = results.groupBy("post_id").agg(F.count(F.lit(1)).alias("_c"))
    j = p.join(r, "post_id", "full_outer")
    return j.agg(
        F.count("_p").alias("posts"),
        F.coalesce(F.sum("_c"), F.lit(0)).alias("results"),
        F.count("_c").alias("distinct_results"),
        (F.coalesce(F.sum("_c"), F.lit(0)) - F.count("_c")).alias("duplicates"),
        F.count_if(F.col("_p").isNotNull() & F.col("_c").isNull()).alias("missing"),
    )


# --------------------------------------------------------------------------- A10
def stuck_pending(posts: DataFrame, results: DataFrame, as_of_ms: int, age_ms: int) -> DataFrame:
    """A10: pending posts older than ``age_ms`` at ``as_of_ms`` with no result (re-enqueue input)."""
    old = posts.where((F.col("review_status") == K.STATUS_PENDING)
                      & (F.col("submitted_ms") < F.lit(as_of_ms - age_ms)))
    return old.join(results.select("post_id"), "post_id", "left_anti") \
        .select("post_id", "user_id", "submitted_ms", (F.lit(as_of_ms) - F.col("submitted_ms")).alias("waiting_ms"))


def reenqueue_tasks(posts: DataFrame, results: DataFrame, as_of_ms: int, age_ms: int) -> DataFrame:
    """A10 -> P3: the review tasks to publish again for posts stuck in pending.

    ``posts`` needs the stored columns (title, content, image_count or
    images, submitted_ms); the tasks are built exactly as at creation.
    """
    from sifter.operators.ingest import build_tasks

    stuck = stuck_pending(posts, results, as_of_ms, age_ms).select("post_id")
    return build_tasks(posts.join(stuck, "post_id", "left_semi"), submitted_col="submitted_ms")


# --------------------------------------------------------------------------- A11
def backlog(deliveries: DataFrame, results: DataFrame, bucket_ms: int) -> DataFrame:
    """Per topic partition and time bucket: enqueued, done, and backlog at the bucket's end.

    Messages are enqueued at submit time; a message is done when its post's
    result is stored.  +1/-1 events reduce to per-(partition, bucket) nets,
    and the running sum runs over those nets only.
    """
    d = deliveries.select("post_id", "partition", F.unix_millis("submitted_at").alias("_t"))
    r = results.select(F.col("post_id").alias("_rp"), "reviewed_ms")
    enq = d.select("partition", F.col("_t").alias("t"), F.lit(1).alias("enq"), F.lit(0).alias("done"))
    dn = d.join(r, d["post_id"] == r["_rp"]).select(
        "partition", F.col("reviewed_ms").alias("t"), F.lit(0).alias("enq"), F.lit(1).alias("done"))
    nets = enq.unionByName(dn).groupBy("partition", F.floor(F.col("t") / bucket_ms).alias("_b")) \
        .agg(F.sum("enq").alias("enqueued"), F.sum("done").alias("done"))
    w = Window.partitionBy("partition").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return nets.select(
        "partition", (F.col("_b") * bucket_ms).alias("bucket_start_ms"), "enqueued", "done",
        F.sum(F.col("enqueued") - F.col("done")).over(w).alias("backlog"))


# --------------------------------------------------------------------------- A12
def dead_letter_summary(dlq: DataFrame) -> DataFrame:
    """Dead letters by reason, original topic and partition."""
    return dlq.groupBy("reason", "original_topic", "partition").agg(F.count(F.lit(1)).alias("messages"))


# --------------------------------------------------------------------------- R2
def admission_summary(decisions: DataFrame, bucket_ms: int) -> DataFrame:
    """R2: offered / admitted / refused requests per time bucket."""
    return decisions.groupBy((F.floor(F.col("t_ms") / bucket_ms) * bucket_ms).alias("bucket_start_ms")) \
        .agg(F.count(F.lit(1)).alias("offered"), F.count_if("admitted").alias("admitted"),
             F.count_if(~F.col("admitted")).alias("refused"))


# --------------------------------------------------------------------------- X5
def outage_windows(lookups: DataFrame, interval_ms: int = 60_000, min_n: int = K.OUTAGE_MIN_REQUESTS,
                   ratio: float = K.OUTAGE_FAILURE_RATIO) -> DataFrame:
    """X5 (batch): tumbling windows where the breaker's trip rule holds.

    n >= ``min_n`` lookups and failures / n > ``ratio`` (strict), over all callers.
    """
    g = lookups.groupBy((F.floor(F.col("t_ms") / interval_ms) * interval_ms).alias("window_start_ms")) \
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("failed").alias("failures"))
    return g.where((F.col("n") >= min_n) & (F.col("failures") > F.lit(ratio) * F.col("n"))) \
        .select("window_start_ms", (F.col("window_start_ms") + interval_ms).alias("window_end_ms"),
                "n", "failures")


# --------------------------------------------------------------------------- X6
def throughput(results: DataFrame, bucket_ms: int = 60_000, time_col: str = "reviewed_ms") -> DataFrame:
    """X6 (batch): results completed per time bucket."""
    return results.groupBy((F.floor(F.col(time_col) / bucket_ms) * bucket_ms).alias("bucket_start_ms")) \
        .agg(F.count(F.lit(1)).alias("results"))


# --------------------------------------------------------------------------- J5
def degraded_during(results: DataFrame, outages: DataFrame, time_col: str = "reviewed_ms",
                    part_rows: int = intervals.PART_ROWS) -> DataFrame:
    """Degraded verdicts that fall inside an outage window [start, end), windows of any length and overlap.

    A sweep over range-dealt verdicts (:mod:`sifter.operators.intervals`).
    """
    points = results.where(F.col("degraded")).select(F.col("post_id").alias("_id"), F.col(time_col).alias("_t"))
    windows = outages.select(F.col("window_start_ms").alias("_start"), F.col("window_end_ms").alias("_end"))
    return intervals.points_in_intervals(points, windows, part_rows).select(
        F.col("_id").alias("post_id"), F.col("_start").alias("window_start_ms"), F.col("_end").alias("window_end_ms"))
