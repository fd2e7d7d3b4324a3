"""The post-status view with a read-time TTL, and the durable post status.

The studied service keeps a post's status twice: in its table, where each
result event sets it as it arrives, and in a cache entry that every write
renews and that expires ten minutes after the write.  The last *applied* write
wins in both, whatever review time it carries.

Here every micro-batch adds the last status per post among its events, with the
time of the write, to a state table (segments merged by size).  Creations,
lookups and result events write to a table each, so every table has one writer.

* The view keeps all writes of its last TTL and ``HISTORY_MS`` before it, so it can be read as of any time in
  that span; asking for an earlier time is an error, never a wrong answer.  Older writes go when segments are
  merged, whole old segments without being read.  A read opens only segments that were written within the TTL.
* The durable status keeps the last write per post, however many batches there were.

Readers take the last write per post; the view keeps it only while
``as_of - written < ttl``.  No keyed state store and no processing-time timers
are needed, so ``availableNow`` runs end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from functools import reduce

from sifter.constants import STATUS_CACHE_TTL_MS, STATUS_PENDING
from sifter.session import checkpoint_root
from sifter.sources.jsonio import parse_results
from sifter.sources.sinks import run_id
from sifter.streaming.state import StateTable

VIEW_SCHEMA = "post_id bigint, status string, written_ms bigint, batch_id bigint"
WRITERS = ("created", "filled", "applied")
HISTORY_MS = 24 * 3_600_000  # how far back a view can be read
Clock = Callable[[int], int]  # batch id -> epoch milliseconds of its write


def last_applied(events: DataFrame) -> DataFrame:
    """(post_id, status) of the last delivered event per post (a post's events share a partition)."""
    return events.groupBy("post_id").agg(F.max_by("status", F.struct("partition", "offset")).alias("status"))


def _each_write(rows: DataFrame) -> DataFrame:
    """One row per post and time of writing."""
    return rows.groupBy("post_id", "written_ms").agg(
        F.max_by(F.struct("status", "batch_id"), F.struct("batch_id", "_seq")).alias("_l")).select(
        "post_id", "_l.status", "written_ms", "_l.batch_id")


def _last_write(rows: DataFrame) -> DataFrame:
    """One row per post."""
    return rows.groupBy("post_id").agg(
        F.max_by(F.struct("status", "written_ms", "batch_id"), F.struct("written_ms", "batch_id", "_seq")).alias("_l")).select(
        "post_id", "_l.status", "_l.written_ms", "_l.batch_id")


def view_table(spark: SparkSession, path: str, writer: str, ttl_ms: int = STATUS_CACHE_TTL_MS, **options) -> StateTable:
    """The entries of one writer of the view at ``path``."""
    return StateTable(spark, f"{path.rstrip('/')}/{writer}", VIEW_SCHEMA, "post_id", _each_write,
                      stamp="written_ms", keep=ttl_ms + HISTORY_MS, **options)


def applied_table(spark: SparkSession, path: str, **options) -> StateTable:
    """The durable statuses at ``path``: the last write per post."""
    return StateTable(spark, f"{path.rstrip('/')}/applied", VIEW_SCHEMA, "post_id", _last_write, **options)


def write_entries(entries: DataFrame, table: StateTable, batch_id: int, run: str | None = None) -> None:
    """Add entries (post_id, status, written_ms): a batch's, or those of a creation or of a table read."""
    run = run or run_id(entries.sparkSession)
    table.begin(run, batch_id)
    table.append(run, batch_id, entries.select("post_id", "status", F.col("written_ms").cast("bigint").alias("written_ms"),
                                               F.lit(batch_id).cast("bigint").alias("batch_id")), None)


def seed_pending(posts: DataFrame, view_path: str, written_ms: Column, batch_id: int = 0) -> None:
    """A created post is written through as pending; ``written_ms`` is its creation time."""
    write_entries(posts.select("post_id", F.lit(STATUS_PENDING).alias("status"), written_ms.alias("written_ms")),
                  view_table(posts.sparkSession, view_path, "created"), batch_id, run="created")


def fill_from_table(found: DataFrame, view_path: str, written_ms: int, batch_id: int) -> None:
    """What a lookup read from the table (post_id, review_status) is kept for the next lookups."""
    write_entries(found.select("post_id", F.col("review_status").alias("status"), F.lit(written_ms).alias("written_ms")),
                  view_table(found.sparkSession, view_path, "filled"), batch_id, run="filled")


def _apply_stream(spark: SparkSession, messages: DataFrame, table: StateTable, name: str, checkpoint: str | None,
                  available_now: bool, clock: Clock | None):
    ckpt = checkpoint or checkpoint_root(spark, name)

    def run(batch: DataFrame, batch_id: int) -> None:
        now = F.unix_millis(F.current_timestamp()) if clock is None else F.lit(clock(batch_id))
        write_entries(last_applied(parse_results(batch)).withColumn("written_ms", now), table, batch_id)

    w = messages.writeStream.foreachBatch(run).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def status_view_stream(spark: SparkSession, messages: DataFrame, view_path: str, *, checkpoint: str | None = None,
                       available_now: bool = True, clock: Clock | None = None):
    """Keep the view at ``view_path`` up to date from result-event messages; ``clock`` gives a batch's write time."""
    return _apply_stream(spark, messages, view_table(spark, view_path, "applied"), "status_view", checkpoint, available_now, clock)


def _last_written(entries: DataFrame) -> DataFrame:
    last = entries.groupBy("post_id").agg(
        F.max_by(F.struct("status", "written_ms"), F.struct("written_ms", "batch_id")).alias("_l"))
    return last.select("post_id", F.col("_l.status").alias("status"), F.col("_l.written_ms").alias("updated_ms"))


def read_status_view(spark: SparkSession, view_path: str, as_of_ms: int,
                     ttl_ms: int = STATUS_CACHE_TTL_MS) -> DataFrame:
    """Live entries at ``as_of_ms``: last write per post, younger than the TTL; none before the first write.

    Rows are cut to the TTL window ``(as_of - ttl, as_of]`` before taking the
    last per post: a post is live exactly when its last write as of ``as_of``
    lies in that window.  Only segments with such writes are opened, however old the view.
    """
    parts = [view_table(spark, view_path, writer, ttl_ms).read_stamped(as_of_ms - ttl_ms, as_of_ms).drop("_seq") for writer in WRITERS]
    return _last_written(reduce(DataFrame.unionByName, parts))


def applied_status_stream(spark: SparkSession, messages: DataFrame, table_path: str, *, checkpoint: str | None = None,
                          available_now: bool = True, clock: Clock | None = None):
    """A2 as a stream: the durable status of posts, set by result events in arrival order; a replay rewrites its batch."""
    return _apply_stream(spark, messages, applied_table(spark, table_path), "applied_status", checkpoint, available_now, clock)


def read_applied_status(spark: SparkSession, posts: DataFrame, table_path: str) -> DataFrame:
    """(post_id, review_status): the last applied status, else the post's own."""
    last = applied_table(spark, table_path).read().select(F.col("post_id").alias("_pid"), "status")
    return posts.join(last, posts["post_id"] == last["_pid"], "left").select(
        "post_id", F.coalesce("status", "review_status").alias("review_status"))
