"""Moderation inputs derived, by Spark, from the driver's generated tables.

Every view reads whole tables and keeps every row, so its work grows with
the scale factor.  Attributes the generated tables lack (author, image
count, submit time, delivery position) are derived from ids with fixed
arithmetic; no view filters rows to make a check cheaper.

* ``posts``     one per ``documents`` row.  Title = first line of the text,
                content = the rest, so the scanned ``title + ' ' + content``
                is the whole text.  One-line texts have empty content.
* ``users``     one per ``customer`` row.  Some posts have authors beyond
                them; those are judged fail-open.
* ``words``     the test block list (raw, folded by the loader).
* ``tasks``     review tasks built from the posts (P3).
* ``deliveries``tasks with a topic position; some posts are delivered twice.
* ``results``   the flagship verdicts with a review time, as stored at the
                snapshot ``AS_OF_MS`` (slow reviews are not stored yet).
* ``requests``  / ``lookups``: ``events`` as HTTP requests and as
                reputation lookups.
* ``task_messages``: JSON task messages plus ``pages.html`` bodies as poison.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.constants import TESTDATA_WORDS

# --- fixed values of the derived views ---------------------------------------
AUTHOR_MULT = 7919                # see author_id
UNKNOWN_SHARE = 8                 # one author id beyond the customers for every 8 customers
BUSY_SHARE = 50                   # half of the posts come from 1 in 50 authors
IMAGE_MOD = 13                    # image count = doc_id % IMAGE_MOD
EPOCH_MS = 1704067200000          # 2024-01-01T00:00:00Z
SUBMIT_STEP_MULT = 7919           # submit second = (doc_id * 7919) % 100003
SUBMIT_STEP_MOD = 100003
PARTITIONS = 3                    # task topic partitions
REDELIVERY_MOD, REDELIVERY_REM = 10, 3   # post_id % 10 = 3 is delivered twice
REVIEW_BASE_MS = 50               # review time = submit + 50 + (id*37) % 1000 ms
REVIEW_SPREAD_MULT, REVIEW_SPREAD_MOD = 37, 1000
PARKED_MOD, PARKED_REM = 25, 7    # these tasks wait 12 h after a consumer crash
PARKED_DELAY_MS = 12 * 3600 * 1000
# Results are read as stored one minute after the last possible submission.
AS_OF_MS = EPOCH_MS + SUBMIT_STEP_MOD * 1000 + 60_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def author_id(spark: SparkSession, sf_dir: str, doc_id: Column) -> Column:
    """A post's author: even ids spread over all customer keys and the ids beyond them, odd ids over a busy few.

    Both grow with the customer table; 0 and ids past the last customer are unknown authors.
    """
    customers = table(spark, sf_dir, "customer").count()  # from the file's footer
    ids = customers + customers // UNKNOWN_SHARE
    return F.when(doc_id % 2 == 0, doc_id * AUTHOR_MULT % max(ids, 1)) \
        .otherwise(F.floor(doc_id / 2) % max(ids // BUSY_SHARE, 1))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """post_id, user_id, title, content, image_count, images_json, submitted_ms, review_status."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    nl = F.instr(text, "\n")
    n_img = (F.col("doc_id") % IMAGE_MOD).cast("int")
    return d.select(
        F.col("doc_id").alias("post_id"),
        author_id(spark, sf_dir, F.col("doc_id")).alias("user_id"),
        F.when(nl > 0, F.substring_index(text, "\n", 1)).otherwise(text).alias("title"),
        F.when(nl > 0, F.expr("substr(coalesce(text, ''), instr(coalesce(text, ''), '\\n') + 1)"))
        .otherwise(F.lit("")).alias("content"),
        n_img.alias("image_count"),
        F.when(n_img == 0, F.lit("[]")).otherwise(
            F.concat(F.lit('["'), F.expr(f"repeat('u\",\"', cast(doc_id % {IMAGE_MOD} - 1 as int))"),
                     F.lit('u"]'))).alias("images_json"),
        (F.lit(EPOCH_MS) + ((F.col("doc_id") * SUBMIT_STEP_MULT) % SUBMIT_STEP_MOD) * 1000)
        .alias("submitted_ms"),
        F.lit("pending").alias("review_status"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, username, email, violation_count, reputation."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    vc = (F.col("c_custkey") % 9).cast("int")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        vc.alias("violation_count"),
        # Users with vc = 8 carry a score off the formula on purpose (A4).
        F.when(vc == 8, F.lit(80)).otherwise(80 - 10 * vc).cast("int").alias("reputation"),
    )


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long block list from a table: every distinct blank-separated token of ``benchmark.text``."""
    b = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", r"[ \n]+")).alias("word"))
    return b.where(F.col("word") != "").distinct()


def raw_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in TESTDATA_WORDS], "word string")


def tasks_from_posts(p: DataFrame) -> DataFrame:
    """The review task of each post (P3 on the derived view)."""
    return p.select(
        "post_id", "user_id", "title",
        F.col("content").alias("content_snapshot"),
        "image_count",
        F.timestamp_millis(F.col("submitted_ms")).alias("submitted_at"),
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks_from_posts(posts(spark, sf_dir))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks with (partition, offset); posts with id % 10 = 3 arrive twice (offset, offset + 1).

    One read of the tasks: the repeat is generated by ``explode``, not by a
    second scan unioned in.
    """
    t = tasks(spark, sf_dir)
    first = F.col("post_id") * 2
    offsets = F.when(F.col("post_id") % REDELIVERY_MOD == REDELIVERY_REM, F.array(first, first + 1)) \
        .otherwise(F.array(first))
    return t.select("*", (F.col("post_id") % PARTITIONS).cast("int").alias("partition"),
                    F.explode(offsets).alias("offset"))


def reviewed_ms(post_id, submitted_ms):
    """Review completion time of a post: submit + 50 + (id*37) % 1000 ms, +12 h for parked tasks."""
    return (submitted_ms + F.lit(REVIEW_BASE_MS) + (post_id * REVIEW_SPREAD_MULT) % REVIEW_SPREAD_MOD
            + F.when(post_id % PARKED_MOD == PARKED_REM, F.lit(PARKED_DELAY_MS)).otherwise(F.lit(0)))


def results(spark: SparkSession, sf_dir: str, strategy: str = "auto") -> DataFrame:
    """Stored results at ``AS_OF_MS``: flagship verdicts + submitted_ms, reviewed_ms."""
    from sifter.plans.moderation import moderate
    from sifter.sources.tables import load_block_list

    v = moderate(tasks(spark, sf_dir), load_block_list(spark, raw_words(spark)), users(spark, sf_dir),
                 strategy=strategy, keep_time=True)
    v = v.withColumn("submitted_ms", F.unix_millis("submitted_at")).drop("submitted_at")
    v = v.withColumn("reviewed_ms", reviewed_ms(F.col("post_id"), F.col("submitted_ms")))
    return v.where(F.col("reviewed_ms") <= AS_OF_MS)


def epoch_ms(df: DataFrame, col: str):
    """Epoch milliseconds of a time column, whatever the session time zone.

    A wall-clock (TIMESTAMP_NTZ) value is read as UTC; an instant is exact.
    """
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_millis(F.col(col))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """request_id, key, t_ms, http_status, latency_ms from ``events``."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("key"),
        epoch_ms(e, "ts").alias("t_ms"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), F.lit(202))
        .when(F.col("event_type") == "signup", F.lit(429))
        .otherwise(F.lit(500)).alias("http_status"),
        F.col("value").alias("latency_ms"),
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, t_ms, failed: reputation lookups and whether each one failed."""
    e = table(spark, sf_dir, "events").select("ts", "user_id", "event_type")
    return e.select(
        "user_id",
        epoch_ms(e, "ts").alias("t_ms"),
        F.col("event_type").isin("error", "signup", "purchase").alias("failed"),
    )


def task_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic, partition, offset, key, value: JSON tasks plus raw HTML bodies as poison."""
    from sifter.sources.jsonio import to_task_json

    t = tasks(spark, sf_dir)
    good = t.select(
        F.lit("review-tasks").alias("topic"),
        (F.col("post_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("post_id") * 2).alias("offset"),
        F.col("post_id").cast("string").alias("key"),
        to_task_json(t).alias("value"),
    )
    pg = table(spark, sf_dir, "pages").select("page_id", "html")
    bad = pg.select(
        F.lit("review-tasks").alias("topic"),
        (F.col("page_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("page_id") * 2 + 1).alias("offset"),
        F.col("page_id").cast("string").alias("key"),
        F.coalesce(F.col("html"), F.lit("")).alias("value"),
    )
    return good.unionByName(bad)
