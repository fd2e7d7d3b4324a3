"""Results side: dedup, idempotency, status, violations, reputation, feed.

All per-key reductions are hash aggregates with partial (map-side)
aggregation, so a post or author with a huge share of rows still reduces on
every mapper first; no operator gathers a key's rows into one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.operators.idfilter import build_filter, may_contain, words_for
from sifter.session import write_and_read


def dedup_deliveries(df: DataFrame, key: str = "post_id",
                     order_cols: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """A1: one row per key, the first delivery (smallest position) wins.

    Every column of ``df`` rides in the ``min_by`` struct through the shuffle,
    so pass only the columns needed (the flagship passes slim, post-scan rows).
    """
    rest = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
    return picked.select(key, *[F.col("_row").getField(c).alias(c) for c in rest])


def unmoderated(tasks: DataFrame, results: DataFrame, key: str = "post_id") -> DataFrame:
    """Tasks whose post has no stored result yet (an anti join needs no distinct)."""
    return tasks.join(results.select(key), key, "left_anti")


def skip_judged(tasks: DataFrame, results: DataFrame, key: str = "post_id") -> DataFrame:
    """The tasks that may be unmoderated, picked where they are read: few others are left, and no text moves.

    Reads only the ids of both sides for an exact anti join, and puts the new
    ids into a Bloom filter that is broadcast (:mod:`sifter.operators.idfilter`,
    12 MB at most).  No new task is lost; a few in a hundred of the judged ones
    pass, more when there are more new ids than the filter holds, so callers
    keep :func:`unmoderated` behind it.
    """
    new = write_and_read(tasks.select(key).distinct().join(results.select(key), key, "left_anti"), "new-ids")
    words = words_for(new.count())
    return may_contain(tasks, key, build_filter(new, key, words), words)


def apply_results(posts: DataFrame, events: DataFrame, *,
                  order_cols: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """A2: set each post's status from its result events; the last applied event wins.

    Events for unknown posts change nothing; applying the same events again
    gives the same table.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    last = events.groupBy(F.col("post_id").alias("_pid")) \
        .agg(F.max_by(F.col("status"), order).alias("_applied"))
    j = posts.join(last, posts["post_id"] == last["_pid"], "left")
    return j.select(*[F.coalesce(F.col("_applied"), F.col("review_status")).alias("review_status")
                      if c == "review_status" else F.col(c) for c in posts.columns])


def violations(results: DataFrame) -> DataFrame:
    """A3: per author, the number of distinct rejected posts."""
    return results.where(F.col("status") == K.STATUS_REJECTED) \
        .groupBy("user_id").agg(F.count_distinct("post_id").alias("violations"))


def update_reputation(users: DataFrame, new_violations: DataFrame) -> DataFrame:
    """A4: add new violations; reputation = max(0, 80 - 10 * count), unchanged when none."""
    v = new_violations.select(F.col("user_id").alias("_vuid"), F.col("violations").alias("_n"))
    j = users.join(v, users["user_id"] == v["_vuid"], "left")
    n = F.coalesce(F.col("_n"), F.lit(0))
    new_count = (F.col("violation_count") + n).cast("int")
    rep = F.when(n > 0, F.greatest(F.lit(K.REPUTATION_MIN),
                                   F.lit(K.REPUTATION_START) - F.lit(K.REPUTATION_PENALTY) * new_count)) \
        .otherwise(F.col("reputation")).cast("int")
    out = []
    for c in users.columns:
        if c == "violation_count":
            out.append(new_count.alias(c))
        elif c == "reputation":
            out.append(rep.alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def post_status(posts: DataFrame, results: DataFrame) -> DataFrame:
    """The result's status when one is stored, else the post's stored status."""
    r = results.select(F.col("post_id").alias("_rpid"), F.col("status").alias("_rstatus"))
    j = posts.join(r, posts["post_id"] == r["_rpid"], "left")
    return j.select(*[c for c in posts.columns if c != "review_status"],
                    F.coalesce(F.col("_rstatus"), F.col("review_status")).alias("review_status"))


def feed_limit(limit) -> int:
    """The feed's page size: non-numbers count as 0; <= 0 or > 100 becomes 20."""
    n = int(str(limit)) if re.fullmatch(r"[+-]?[0-9]+", str(limit)) else 0
    return K.FEED_DEFAULT_LIMIT if n <= 0 or n > K.FEED_MAX_LIMIT else n


def approved_feed(posts: DataFrame, limit=K.FEED_DEFAULT_LIMIT) -> DataFrame:
    """Approved posts, newest id first, at most ``feed_limit(limit)`` rows.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge.
    """
    return posts.where(F.col("review_status") == K.STATUS_APPROVED) \
        .orderBy(F.col("post_id").desc()).limit(feed_limit(limit))


def status_lookup(posts: DataFrame, ids: DataFrame, id_col: str = "post_id",
                  view: DataFrame | None = None) -> DataFrame:
    """Status for each asked id, whatever the state; ``found`` is false for unknown ids.

    ``view``: live status-view entries (post_id, status), e.g. from
    :func:`sifter.streaming.status_view.read_status_view`; read first, as the
    service reads its cache before the table.
    """
    p = posts.select(F.col("post_id").alias("_pid"), F.col("review_status").alias("_st"))
    j = ids.select(F.col(id_col).alias("post_id")).join(p, F.col("post_id") == F.col("_pid"), "left")
    status = F.col("_st")
    if view is not None:
        v = view.select(F.col("post_id").alias("_vid"), F.col("status").alias("_vst"))
        j = j.join(v, F.col("post_id") == F.col("_vid"), "left")
        status = F.coalesce(F.col("_vst"), status)
    return j.select("post_id", F.col("_pid").isNotNull().alias("found"), status.alias("review_status"))
