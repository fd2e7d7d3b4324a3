"""A10, A7 over streams: posts and results joined in event time, across batches and a restart."""

import os

from pyspark.sql import functions as F

from sifter.streaming.pending import latency_stream, stuck_pending_stream

POSTS = "post_id long, user_id long, review_status string, s long"
RESULTS = "post_id long, s long"


def _write(spark, path, rows, schema, time):
    spark.createDataFrame(rows, schema).withColumn(time, F.timestamp_seconds(F.col("s") + 3600)).drop("s").coalesce(1) \
        .write.mode("append").parquet(path)


def _run(spark, scratch, to_stream):
    """Everything new in the two folders, until no more can be closed."""
    p, r = os.path.join(scratch, "posts"), os.path.join(scratch, "results")
    streams = [spark.readStream.schema(spark.read.parquet(x).schema).parquet(x) for x in (p, r)]
    to_stream(*streams).writeStream.format("parquet").option("path", os.path.join(scratch, "sink")) \
        .option("checkpointLocation", os.path.join(scratch, "ckpt")).outputMode("append") \
        .trigger(availableNow=True).start().awaitTermination()
    return sorted(tuple(x) for x in spark.read.parquet(os.path.join(scratch, "sink")).collect())


def test_posts_without_a_result_are_emitted_once_over_restarts(spark, scratch):
    p, r = os.path.join(scratch, "posts"), os.path.join(scratch, "results")

    def stuck(posts, results):
        return stuck_pending_stream(posts, results, age="100 seconds", delay="10 seconds").select("post_id")

    _write(spark, p, [(1, 9, "pending", 0), (2, 9, "pending", 5), (3, 9, "approved", 6), (4, 9, "pending", 7),
                      (5, 9, "pending", 150), (None, 9, "pending", 8), (8, 9, "pending", None)], POSTS, "submitted_at")
    _write(spark, r, [(1, 50), (1, 51), (99, 90), (None, 60), (2, None)], RESULTS, "reviewed_at")
    assert _run(spark, scratch, stuck) == []  # both streams have to pass 100 + 10 seconds
    _write(spark, r, [(5, 200), (4, 120), (77, 260)], RESULTS, "reviewed_at")  # 4: after its 100 seconds
    _write(spark, p, [(6, 9, "pending", 200)], POSTS, "submitted_at")
    assert _run(spark, scratch, stuck) == [(2,), (4,)]
    # a late result takes nothing back; what is left is closed in time, once
    _write(spark, r, [(2, 90), (78, 900)], RESULTS, "reviewed_at")
    _write(spark, p, [(7, 9, "pending", 900)], POSTS, "submitted_at")
    assert _run(spark, scratch, stuck) == [(2,), (4,), (6,)]


def test_latencies_of_closed_windows(spark, scratch):
    p, r = os.path.join(scratch, "posts"), os.path.join(scratch, "results")
    _write(spark, p, [(i, 9, "pending", i) for i in range(60)] + [(99, 9, "pending", 1000)], POSTS, "submitted_at")
    _write(spark, r, [(i, i + 1 + i % 10) for i in range(60)] + [(98, 1000), (0, 500)], RESULTS, "reviewed_at")
    got = _run(spark, scratch, lambda a, b: latency_stream(a, b, interval="30 seconds", age="100 seconds", delay="0 seconds"))
    want = {}
    for i in range(60):
        want.setdefault((i + 1 + i % 10) // 30, []).append(1000 * (1 + i % 10))
    assert got == [(3_600_000 + 30_000 * w, len(x), sum(x), sorted(x)[-(-len(x) // 2) - 1], sorted(x)[-(-99 * len(x) // 100) - 1], max(x))
                   for w, x in sorted(want.items())]
