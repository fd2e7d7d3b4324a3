"""A10, A7 over streams: posts joined with their results in event time.

Both streams are watermarked, so a post waits in state for its result no
longer than ``age`` (plus the delay allowed to late rows), and a result no longer
than until posts of its time are closed.  State is spread by post id and does
not grow with history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter import constants as K


def _waiting(posts: DataFrame, results: DataFrame, age: str, delay: str, how: str) -> DataFrame:
    """Posts with their results of the next ``age``; rows without an id or time, which could never be closed, are left out."""
    p = posts.dropna(subset=["post_id", "submitted_at"]).withWatermark("submitted_at", delay)
    r = results.select(F.col("post_id").alias("_rp"), "reviewed_at").dropna().withWatermark("reviewed_at", delay)
    in_time = F.expr(f"post_id = _rp AND reviewed_at >= submitted_at AND reviewed_at <= submitted_at + INTERVAL {age}")
    return p.join(r, in_time, how)


def stuck_pending_stream(posts: DataFrame, results: DataFrame, age: str = "1 hour", delay: str = "2 minutes") -> DataFrame:
    """A10 (stream): (post_id, user_id, submitted_ms) of each pending post without a result in ``age``, emitted once.

    A post is judged when both streams have passed its
    submission by ``age`` and ``delay``; a result that comes after that does
    not take it back.  Repeated results change nothing; a repeated post is
    emitted as often as it came.  Rows without an id or time are left out.
    """
    pending = posts.where(F.col("review_status") == K.STATUS_PENDING).select("post_id", "user_id", "submitted_at")
    return _waiting(pending, results, age, delay, "left_outer").where(F.col("_rp").isNull()).select(
        "post_id", "user_id", F.unix_millis("submitted_at").alias("submitted_ms"))


def latency_stream(posts: DataFrame, results: DataFrame, interval: str = "10 minutes", age: str = "1 day",
                   delay: str = "2 minutes") -> DataFrame:
    """A7 (stream): per window of review times the number of results, their mean, percentiles and largest latency.

    Only results within ``age`` of their post's submission count; a result
    that is delivered again counts again unless the caller drops repeats before.
    The percentiles come from a mergeable sketch (exact up to its 10,000
    values a window, then at a rank error of one in 10,000).
    """
    ms = F.unix_millis("reviewed_at") - F.unix_millis("submitted_at")
    each = _waiting(posts.select("post_id", "submitted_at"), results, age, delay, "inner") \
        .select("reviewed_at", ms.alias("ms"))
    return each.groupBy(F.window("reviewed_at", interval).alias("w")).agg(
        F.count(F.lit(1)).alias("results"), F.sum("ms").alias("total_latency_ms"),
        F.percentile_approx("ms", [0.5, 0.99], 10_000).alias("p"), F.max("ms").alias("max_latency_ms")).select(
        F.unix_millis("w.start").alias("bucket_start_ms"), "results", "total_latency_ms",
        F.col("p")[0].alias("p50"), F.col("p")[1].alias("p99"), "max_latency_ms")
