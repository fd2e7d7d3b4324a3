"""Event-time windows over streams (watermarked, append mode).

The studied service has no event-time rule; these are the analysis forms
of its breaker trip rule and its completion log.  Windows are tumbling;
a window is emitted once the watermark (max event time - ``delay``) passes
its end, and its state is dropped then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter import constants as K


def outage_windows_stream(lookups: DataFrame, interval: str = "60 seconds", delay: str = "2 minutes",
                          min_n: int = K.OUTAGE_MIN_REQUESTS, ratio: float = K.OUTAGE_FAILURE_RATIO,
                          time_col: str = "ts") -> DataFrame:
    """X5 (stream): windows with n >= min_n lookups and failures / n > ratio."""
    g = lookups.withWatermark(time_col, delay).groupBy(F.window(time_col, interval).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("failed").alias("failures"))
    return g.where((F.col("n") >= min_n) & (F.col("failures") > F.lit(ratio) * F.col("n"))).select(
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        F.unix_millis(F.col("w.end")).alias("window_end_ms"), "n", "failures")


def throughput_stream(results: DataFrame, interval: str = "60 seconds", delay: str = "2 minutes",
                      time_col: str = "reviewed_at") -> DataFrame:
    """X6 (stream): results completed per tumbling window."""
    return results.withWatermark(time_col, delay).groupBy(F.window(time_col, interval).alias("w")) \
        .agg(F.count(F.lit(1)).alias("results")) \
        .select(F.unix_millis(F.col("w.start")).alias("bucket_start_ms"), "results")
