"""Stored tables: posts, users, block list (I1, I2) and their schemas.

Go zero values become explicit defaults at ingest: strings ``''``, numbers
``0``, image lists ``[]``.  Readers accept a path (parquet unless told
otherwise) or an existing DataFrame, so the same code serves files, JDBC
extracts and test fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.constants import REPUTATION_START
from sifter.functions.text import ascii_fold

# Bound for collecting the block list into one broadcast (see collect_block_list).
# Every Python worker process builds its own automaton from it (an 8-core
# executor holds 8), so the bound is set by per-process memory, not by the
# broadcast itself; larger lists are scanned exactly by operators.scan.probed_hits.
MAX_BLOCK_WORDS = 500_000
MAX_BLOCK_BYTES = 16 * 1024 * 1024


def _load(spark: SparkSession, src, fmt: str = "parquet", **options) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    return spark.read.format(fmt).options(**options).load(src)


def read_posts(spark: SparkSession, src, fmt: str = "parquet", on_broken: str = "fail",
               **options) -> DataFrame:
    """Posts with ``images`` as ``array<string>``.

    ``images`` may arrive as JSON text (the stored form) or already as an
    array.  NULL or empty text means ``[]``.  Broken JSON fails the job at
    run time (``on_broken="fail"``, the studied service's behaviour), or,
    with ``on_broken="quarantine"``, reads as ``[]`` and sets
    ``images_broken`` so the caller can route the row aside.
    """
    if on_broken not in ("fail", "quarantine"):
        raise ValueError(f"on_broken must be 'fail' or 'quarantine', not {on_broken!r}")
    df = _load(spark, src, fmt, **options)
    fields = dict(df.dtypes)
    empty = F.array().cast("array<string>")
    broken = F.lit(False)
    if fields.get("images", "").startswith("array"):
        images = F.coalesce(F.col("images"), empty)
    elif "images" in fields:
        raw = F.trim(F.col("images"))
        parsed = F.from_json(raw, "array<string>")
        broken = raw.isNotNull() & (raw != "") & parsed.isNull()
        bad = F.raise_error(F.concat(F.lit("broken images JSON: "), raw)).cast("array<string>") \
            if on_broken == "fail" else empty
        images = F.when(raw.isNull() | (raw == ""), empty).otherwise(F.when(parsed.isNotNull(), parsed).otherwise(bad))
    else:
        images = empty
    extra = [broken.alias("images_broken")] if on_broken == "quarantine" else []
    return df.select(
        F.col("post_id").cast("bigint").alias("post_id"),
        F.coalesce(F.col("user_id").cast("bigint"), F.lit(0).cast("bigint")).alias("user_id"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        images.alias("images"),
        F.coalesce(F.col("review_status"), F.lit("pending")).alias("review_status")
        if "review_status" in fields else F.lit("pending").alias("review_status"),
        (F.col("created_at").cast("timestamp") if "created_at" in fields
         else F.lit(None).cast("timestamp")).alias("created_at"),
        *extra,
    )


def read_users(spark: SparkSession, src, fmt: str = "parquet", **options) -> DataFrame:
    """Users as the reputation service sees them (no password hash)."""
    df = _load(spark, src, fmt, **options)
    return df.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.coalesce(F.col("username"), F.lit("")).alias("username"),
        F.coalesce(F.col("email"), F.lit("")).alias("email"),
        F.coalesce(F.col("reputation").cast("int"), F.lit(REPUTATION_START)).alias("reputation"),
        F.coalesce(F.col("violation_count").cast("int"), F.lit(0)).alias("violation_count"),
    )


def load_block_list(spark: SparkSession, src, column: str = "word", fmt: str = "parquet",
                    **options) -> DataFrame:
    """I2 (+S1): the folded, non-empty, distinct words as a one-column DataFrame."""
    df = _load(spark, src, fmt, **options)
    folded = ascii_fold(F.col(column)).alias("word")
    return df.select(folded).where(F.col("word").isNotNull() & (F.col("word") != "")).distinct()


def block_list_from_values(spark: SparkSession, words) -> DataFrame:
    """Block list from literal values (seed/demo lists, tests)."""
    raw = spark.createDataFrame([(w,) for w in words], "word string")
    return load_block_list(spark, raw)


class BlockListTooLarge(ValueError):
    """The block list is over the single-broadcast bound."""


def collect_block_list(words: DataFrame, max_words: int | None = None,
                       max_bytes: int | None = None) -> list[str]:
    """Bring the block list to the driver for broadcast, after checking its size.

    The list is the only thing this package collects.  It is bounded the way
    the studied service bounds it (every worker holds the whole automaton in
    memory).  One job: at most ``max_words + 1`` rows ever reach the driver,
    so an oversize list is detected without collecting it.  A list over the
    bound raises :class:`BlockListTooLarge` instead of being truncated;
    :func:`sifter.operators.scan.probed_hits` scans such a list exactly, in one
    pass over the texts.
    """
    max_words = max_words or MAX_BLOCK_WORDS
    rows = [r["word"] for r in words.select("word").limit(max_words + 1).collect()]
    return sorted(check_block_list(rows, max_words, max_bytes))


def check_block_list(rows: list[str], max_words: int | None = None, max_bytes: int | None = None) -> list[str]:
    """The words, if they fit one broadcast; else :class:`BlockListTooLarge`."""
    max_words = max_words or MAX_BLOCK_WORDS
    max_bytes = max_bytes or MAX_BLOCK_BYTES
    size = sum(len(w.encode("utf-8", "surrogatepass")) for w in rows)
    if len(rows) > max_words or size > max_bytes:
        raise BlockListTooLarge(
            f"block list has over {max_words} words or {max_bytes} bytes: over the broadcast bound. "
            "sifter.operators.scan.probed_hits scans it exactly.")
    return rows
