"""Demo seeds (A13) and the synthetic post generator (G1).

These make small, fixed inputs for tests and demos; the registered queries
never use them (they read the driver's tables instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter import constants as K


def seed_users(spark: SparkSession) -> DataFrame:
    """Alice 80/0, bob 80/0, troll 20/6."""
    return spark.createDataFrame(
        K.SEED_USERS, "user_id bigint, username string, email string, reputation int, violation_count int")


def seed_words(spark: SparkSession) -> DataFrame:
    """The demo block list (raw; fold with ``load_block_list``)."""
    return spark.createDataFrame([(w,) for w in K.SEED_WORDS], "word string")


def generate_tasks(spark: SparkSession, n: int, bad_ratio: float = 0.1, n_users: int = 3, seed: int = 7,
                   start_ms: int = 1704067200000, step_ms: int = 5, partitions: int | None = None) -> DataFrame:
    """G1: ``n`` synthetic review tasks, generated in parallel by ``spark.range``.

    Content is a fixed sentence plus a random number below 1,000,000; a
    ``bad_ratio`` share also has a seed block word.  Authors are
    1..``n_users``; submit times step by ``step_ms``.
    """
    r = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(0, n)
    num = F.floor(F.rand(seed) * 1_000_000).cast("bigint").cast("string")
    bad = F.rand(seed + 1) < bad_ratio
    content = F.concat(F.lit(K.LOADGEN_SENTENCE), num,
                       F.when(bad, F.lit(K.LOADGEN_BAD_SUFFIX)).otherwise(F.lit("")))
    return r.select(
        (F.col("id") + 1).alias("post_id"),
        (F.lit(1) + F.floor(F.rand(seed + 2) * n_users)).cast("bigint").alias("user_id"),
        F.lit(K.LOADGEN_TITLE).alias("title"),
        content.alias("content_snapshot"),
        F.lit(0).alias("image_count"),
        F.timestamp_millis(F.lit(start_ms) + F.col("id") * step_ms).alias("submitted_at"),
    )
