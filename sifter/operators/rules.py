"""Rule engine pieces (E1-E3), the reputation join (J1) and prior violations.

Rules run in a fixed order and the first hit wins:

1. no content (0 code points) and no image -> rejected, ``empty post``;
   more than ``max_content`` code points -> rejected, length;
2. more than ``max_images`` images        -> rejected, images;
3. a block-list word in ``title + ' ' + content`` -> rejected, word;
4. author known, not degraded, reputation below the floor -> manual review;
5. otherwise approved.

Rules 1-3 never read reputation, and only a rejection changes it, so the
reputation an author has when post *k* is judged is a function of the seed
and of the number of earlier rule-1-3 rejections: a running count, not a
recursion (W1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.functions.text import code_points, scan_text
from sifter.operators.ordered import no_heavy_keys, running_agg
from sifter.operators.scan import first_match_col, prepare_scan_text, probed_hits, word_list_or_table


def content_reason(content: Column, image_count: Column, max_content: int = K.MAX_CONTENT_CHARS,
                   max_images: int = K.MAX_IMAGES) -> Column:
    """E1 (a)-(c): the reason of the first failing cheap rule, else NULL."""
    n = code_points(content)
    return (F.when((n == 0) & (image_count == 0), F.lit(K.REASON_EMPTY))
            .when(n > max_content, F.lit(K.REASON_TOO_LONG))
            .when(image_count > max_images, F.lit(K.REASON_TOO_MANY_IMAGES)))


def content_rules(tasks: DataFrame, words, *, max_content: int = K.MAX_CONTENT_CHARS,
                  max_images: int = K.MAX_IMAGES, strategy: str = "auto",
                  max_words: int | None = None, max_bytes: int | None = None,
                  keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``rule_reason`` (NULL when rules 1-3 pass) and ``matched_word`` (NULL when none).

    Only rows that pass the cheap rules reach the scan; the others hand the
    scan a NULL text, which costs nothing on either side of the Arrow hop.
    The scan text is projected once before the scan: Catalyst does not share
    sub-expressions inside lambda functions, so inlining it would rebuild it
    for every word.  A list over the broadcast bound (``max_words``,
    ``max_bytes``) is scanned in one pass too, delivery by delivery, with the same
    answers; its rows are written once, so callers name the columns they need
    (``keep``; all, if not given).
    """
    cols = list(tasks.columns)
    kept = list(keep or cols)
    # Go zero values for NULLs (as the decoder gives them): "" text, 0 images.
    zeroed = {"title": F.coalesce(F.col("title"), F.lit("")),
              "content_snapshot": F.coalesce(F.col("content_snapshot"), F.lit("")),
              "image_count": F.coalesce(F.col("image_count"), F.lit(0))}
    tasks = tasks.select(*[zeroed[c].alias(c) if c in zeroed else F.col(c) for c in cols])
    pre = content_reason(F.col("content_snapshot"), F.col("image_count"), max_content, max_images)
    staged = tasks.select(*cols, pre.alias("_pre"))
    text = F.when(F.col("_pre").isNull(), scan_text("title", "content_snapshot"))
    wl = word_list_or_table(tasks.sparkSession, words, max_words, max_bytes)
    if isinstance(wl, DataFrame):
        judged = probed_hits(staged.select(*kept, "_pre", text.alias("_text")), "_text", wl, every=False)
    else:
        staged = staged.select(*cols, "_pre", prepare_scan_text(text, wl, strategy).alias("_text"))
        hit = first_match_col(F.col("_text"), wl, strategy, prepared=True)
        judged = staged.select(*cols, "_pre", hit.alias("matched_word"))
    return judged.select(
        *kept,
        F.coalesce(F.col("_pre"), F.when(F.col("matched_word").isNotNull(),
                                         F.lit(K.REASON_SENSITIVE))).alias("rule_reason"),
        F.when(F.col("_pre").isNull(), F.col("matched_word")).alias("matched_word"),
    )


def with_reputation(df: DataFrame, users: DataFrame) -> DataFrame:
    """Seed reputation and violation count per row; unknown author -> 80 and degraded.

    Plain left join: Catalyst/AQE broadcast ``users`` when its measured size
    is under the broadcast threshold and shuffle-join it otherwise (with AQE
    splitting a skewed author partition).
    """
    u = users.select(
        F.col("user_id").alias("_uid"),
        F.col("reputation").alias("seed_reputation"),
        F.col("violation_count").alias("seed_violations"),
    )
    j = df.join(u, df["user_id"] == u["_uid"], "left")
    return j.select(
        *df.columns,
        F.col("_uid").isNull().alias("degraded"),
        F.coalesce(F.col("seed_reputation"), F.lit(K.REPUTATION_START)).alias("seed_reputation"),
        F.coalesce(F.col("seed_violations"), F.lit(0)).alias("seed_violations"),
    )


def prior_violations(df: DataFrame, flag_col: str, *, order_col: str = "submitted_at",
                     tie_col: str = "post_id", bucket_ms: int = 60_000,
                     out: str = "prior_rejections", split_heavy: bool = True) -> DataFrame:
    """Per author, how many earlier rows in (order_col, tie_col) order have ``flag_col`` = 1.

    A plain ``sum() over (partition by user_id order by ...)`` would send all
    of an author's rows to one task.  :func:`running_agg` keeps that plain
    window for ordinary authors and spreads sampled heavy authors over
    (author, ``bucket_ms`` time bucket) cells: one-minute cells give a
    prolific author ~1,440 groups a day, and the cell-total table stays small
    (heavy authors x active minutes).
    """
    t = F.col(order_col)
    ms = F.unix_millis(t) if dict(df.dtypes)[order_col].startswith("timestamp") else t
    hot = None if split_heavy else no_heavy_keys(df, ["user_id"])
    r = running_agg(df, ["user_id"], [order_col, tie_col], flag_col, "_prior",
                    F.floor(ms / F.lit(bucket_ms)), fn="sum", inclusive=False, hot=hot)
    return r.select(*df.columns, F.coalesce(F.col("_prior"), F.lit(0)).cast("bigint").alias(out))


def reputation_when_judged(seed_reputation: Column, seed_violations: Column, prior: Column) -> Column:
    """Seed score while the author has no new violation, else max(0, 80 - 10 * count)."""
    return F.when(prior == 0, seed_reputation).otherwise(
        F.greatest(F.lit(K.REPUTATION_MIN),
                   F.lit(K.REPUTATION_START) - F.lit(K.REPUTATION_PENALTY) * (seed_violations + prior))
    ).cast("int")


def verdict_columns(rule_reason: Column, matched_word: Column, reputation: Column, degraded: Column,
                    reputation_floor: int = K.REPUTATION_FLOOR) -> tuple[Column, Column, Column]:
    """E2 + E3: (status, reason, matched_word) from the rule-1-3 outcome and reputation."""
    low = (~degraded) & (reputation < reputation_floor)
    status = (F.when(rule_reason.isNotNull(), F.lit(K.STATUS_REJECTED))
              .when(low, F.lit(K.STATUS_MANUAL))
              .otherwise(F.lit(K.STATUS_APPROVED)))
    reason = (F.when(rule_reason.isNotNull(), rule_reason)
              .when(low, F.lit(K.REASON_LOW_REPUTATION))
              .otherwise(F.lit(K.REASON_PASSED)))
    return status, reason, F.coalesce(matched_word, F.lit(""))


def reputation_gate(verdicts: DataFrame, reputation_floor: int = K.REPUTATION_FLOOR) -> DataFrame:
    """E2/E3 on a frame holding rule_reason, matched_word, reputation and degraded."""
    status, reason, word = verdict_columns(F.col("rule_reason"), F.col("matched_word"),
                                           F.col("reputation"), F.col("degraded"), reputation_floor)
    keep = [c for c in verdicts.columns if c not in ("status", "reason", "matched_word", "rule_reason")]
    return verdicts.select(*keep, status.alias("status"), reason.alias("reason"), word.alias("matched_word"))
