"""The flagship job (E4): review tasks -> one verdict per post.

Plan shape (see ``tests/test_plans.py`` for the checks on it):

    tasks ─ rules 1-3 + word scan (map-only; the text is dropped right after)
          ─ A1 dedup (hash aggregate, partial) ─ J2 anti join prior results (slim rows)
          ─ checkpoint of the slim rows (read twice below, computed once)
          ─ W1 prior rejections per author (plain window; sampled heavy authors
            spread over one-minute cells)
          ─ J1 users (broadcast when measured small, else shuffle join)
          ─ E2/E3 status and reason

Only slim rows (ids, time, reason, word) exist after the scan, so every
shuffle moves a few dozen bytes per post, not the post text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.operators.results import dedup_deliveries, skip_judged, unmoderated
from sifter.operators.rules import (
    content_rules,
    prior_violations,
    reputation_when_judged,
    verdict_columns,
    with_reputation,
)
from sifter.session import ensure_checkpoint_dir

VERDICT_COLUMNS = ["post_id", "user_id", "status", "reason", "matched_word", "degraded"]


def moderate(tasks: DataFrame, words, users: DataFrame, prior_results: DataFrame | None = None, *,
             prior_counts: DataFrame | None = None,
             max_content: int = K.MAX_CONTENT_CHARS, max_images: int = K.MAX_IMAGES,
             reputation_floor: int = K.REPUTATION_FLOOR, strategy: str = "auto",
             bucket_ms: int = 60_000, dedup: bool = True, keep_time: bool = False,
             materialize: bool = True, split_heavy: bool = True,
             max_words: int | None = None, max_bytes: int | None = None,
             skip_first: bool = True) -> DataFrame:
    """Judge every task once.

    ``tasks``: post_id, user_id, title, content_snapshot, image_count,
    submitted_at (+ partition/offset when deliveries may repeat).
    ``users``: the seed state before any of ``tasks`` and ``prior_results``.
    ``prior_results``: verdicts already stored (post_id, user_id, status); their
    posts are skipped (J2) and their rejections count for the authors.
    ``prior_counts``: (user_id, rejections) already stored; when given, it is
    used for the authors' earlier rejections instead of ``prior_results``
    (a stream keeps these per-batch deltas so it need not re-read history).
    Order among one author's posts: (submitted_at, post_id).
    ``materialize``: write the slim judged rows (ids, time, reason, word; no
    text) once to the session's checkpoint folder.  The running count reads
    them more than once (heavy-author sample, then the windows); without this
    the scan would run again for each read.
    ``max_words``, ``max_bytes``: broadcast bound of the block list; beyond it
    the texts are probed with a filter of it, in one pass, with the same verdicts.
    Building the frame runs jobs: the list is collected, the slim rows are
    written, and heavy authors are looked for.
    ``skip_first``: drop judged posts where their tasks are read, by a filter of
    the new ids, so a re-run over a judged history scans next to no text; the
    exact check stays behind it.  A micro-batch, nearly all of it new, skips it.
    ``split_heavy``: sample for heavy authors and spread them over time cells.
    A bounded input (one micro-batch) can skip it; with ``materialize=False``
    the scan output is then read exactly once and nothing is written.
    """
    positions = dedup and "partition" in tasks.columns and "offset" in tasks.columns
    pos_cols = ["partition", "offset"] if positions else []
    t = tasks.select("post_id", "user_id", "title", "content_snapshot", "image_count", "submitted_at", *pos_cols)

    if prior_results is not None and skip_first:
        t = skip_judged(t, prior_results)
    # Rules 1-3 and the scan first, map-only; from here on rows are slim, so
    # dedup (A1) and the done-work check (J2) shuffle ids, never post text.
    # A repeated delivery costs one more scan of its text instead.
    judged = content_rules(t, words, max_content=max_content, max_images=max_images, strategy=strategy,
                           max_words=max_words, max_bytes=max_bytes, keep=["post_id", "user_id", "submitted_at", *pos_cols]) \
        .select("post_id", "user_id", "submitted_at", "rule_reason", "matched_word", *pos_cols)
    if positions:
        judged = dedup_deliveries(judged).drop(*pos_cols)
    if prior_results is not None:
        judged = unmoderated(judged, prior_results)
    judged = judged.select("post_id", "user_id", "submitted_at", "rule_reason", "matched_word",
                           F.col("rule_reason").isNotNull().cast("int").alias("_rej"))
    if materialize:
        ensure_checkpoint_dir(judged.sparkSession)
        judged = judged.checkpoint(eager=True)

    counted = prior_violations(judged, "_rej", bucket_ms=bucket_ms, split_heavy=split_heavy)
    earlier = None
    if prior_counts is not None:
        earlier = prior_counts.groupBy(F.col("user_id").alias("_puid")) \
            .agg(F.sum("rejections").alias("_prev"))
    elif prior_results is not None:
        earlier = prior_results.where(F.col("status") == K.STATUS_REJECTED) \
            .groupBy(F.col("user_id").alias("_puid")) \
            .agg(F.count_distinct("post_id").alias("_prev"))
    if earlier is not None:
        counted = counted.join(earlier, counted["user_id"] == earlier["_puid"], "left") \
            .select(*counted.columns, F.coalesce(F.col("_prev"), F.lit(0)).alias("_prev")) \
            .withColumn("prior_rejections", F.col("prior_rejections") + F.col("_prev")).drop("_prev")

    rep = with_reputation(counted, users)
    reputation = reputation_when_judged(F.col("seed_reputation"), F.col("seed_violations"),
                                        F.col("prior_rejections"))
    status, reason, word = verdict_columns(F.col("rule_reason"), F.col("matched_word"), reputation,
                                           F.col("degraded"), reputation_floor)
    cols = [F.col("post_id"), F.col("user_id"), status.alias("status"), reason.alias("reason"),
            word.alias("matched_word"), F.col("degraded")]
    if keep_time:
        cols.append(F.col("submitted_at"))
    return rep.select(*cols)
