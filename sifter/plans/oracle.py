"""Oracle SQL (DuckDB dialect) for the registered queries.

The derived views of :mod:`sifter.sources.testdata` are restated here as
CTEs over the driver's raw tables, so DuckDB recomputes every answer from
scratch.  The word scan is stated in its closed form: among the words
contained in the folded text, the one with the smallest end position, ties
to the longest.
"""

from __future__ import annotations

from sifter.constants import LOWER_ASCII, TESTDATA_WORDS, UPPER_ASCII
from sifter.sources import testdata as TD


def _fold(expr: str) -> str:
    return f"translate({expr}, '{UPPER_ASCII}', '{LOWER_ASCII}')"


def _words_values() -> str:
    vals = ", ".join("('" + w.replace("'", "''") + "')" for w in TESTDATA_WORDS)
    return f"(VALUES {vals}) AS raw_words(w)"


POSTS = f"""
posts AS (
  SELECT doc_id AS post_id,
         CASE WHEN doc_id % 2 = 0 THEN doc_id * {TD.AUTHOR_MULT} % greatest(ids, 1)
              ELSE doc_id // 2 % greatest(ids // {TD.BUSY_SHARE}, 1) END AS user_id,
         CASE WHEN strpos(coalesce(text, ''), chr(10)) > 0
              THEN split_part(coalesce(text, ''), chr(10), 1) ELSE coalesce(text, '') END AS title,
         CASE WHEN strpos(coalesce(text, ''), chr(10)) > 0
              THEN substr(coalesce(text, ''), strpos(coalesce(text, ''), chr(10)) + 1) ELSE '' END AS content,
         CAST(doc_id % {TD.IMAGE_MOD} AS INTEGER) AS image_count,
         {TD.EPOCH_MS} + ((doc_id * {TD.SUBMIT_STEP_MULT}) % {TD.SUBMIT_STEP_MOD}) * 1000 AS submitted_ms,
         'pending' AS review_status
  FROM documents, (SELECT count(*) + count(*) // {TD.UNKNOWN_SHARE} AS ids FROM customer)
)"""

USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name || '@example.com' AS email,
         CAST(c_custkey % 9 AS INTEGER) AS violation_count,
         CAST(CASE WHEN c_custkey % 9 = 8 THEN 80 ELSE 80 - 10 * (c_custkey % 9) END AS INTEGER) AS reputation
  FROM customer
)"""

WORDS = f"""
words AS (
  SELECT DISTINCT {_fold('w')} AS word FROM {_words_values()} WHERE {_fold('w')} <> ''
)"""

# The long list of benchmark tokens, in place of the short one.
LONG_WORDS = f"""
words AS (
  SELECT DISTINCT {_fold('w')} AS word
  FROM (SELECT unnest(string_split_regex(text, '[ \\n]+')) AS w FROM benchmark) WHERE w <> ''
)"""

# Rules 1-3 and the scan; the scan only for rows the cheap rules let through.
JUDGED = f"""
pre AS (
  SELECT p.*,
         CASE WHEN length(content) = 0 AND image_count = 0 THEN 'empty post'
              WHEN length(content) > 5000 THEN 'content exceeds length limit'
              WHEN image_count > 9 THEN 'too many images' END AS pre_reason,
         {_fold("title || ' ' || content")} AS folded
  FROM posts p
),
hits AS (
  SELECT pre.post_id,
         arg_min(w.word, (strpos(pre.folded, w.word) + length(w.word) - 1) * 1000000 - length(w.word)) AS word
  FROM pre JOIN words w ON strpos(pre.folded, w.word) > 0
  WHERE pre.pre_reason IS NULL
  GROUP BY pre.post_id
),
judged AS (
  SELECT pre.post_id, pre.user_id, pre.submitted_ms, pre.image_count,
         coalesce(pre.pre_reason, CASE WHEN h.word IS NOT NULL THEN 'sensitive word detected' END) AS rule_reason,
         h.word AS matched_word
  FROM pre LEFT JOIN hits h ON h.post_id = pre.post_id
)"""

VERDICTS = """
counted AS (
  SELECT j.*,
         coalesce(sum(CASE WHEN rule_reason IS NOT NULL THEN 1 ELSE 0 END) OVER (
             PARTITION BY user_id ORDER BY submitted_ms, post_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_rejections
  FROM judged j
),
rep AS (
  SELECT c.*, u.user_id IS NULL AS degraded,
         CASE WHEN u.user_id IS NULL THEN 80
              WHEN c.prior_rejections = 0 THEN u.reputation
              ELSE greatest(0, 80 - 10 * (u.violation_count + c.prior_rejections)) END AS reputation
  FROM counted c LEFT JOIN users u ON u.user_id = c.user_id
),
verdicts AS (
  SELECT post_id, user_id, submitted_ms,
         CASE WHEN rule_reason IS NOT NULL THEN 'rejected'
              WHEN NOT degraded AND reputation < 30 THEN 'manual_review'
              ELSE 'approved' END AS status,
         CASE WHEN rule_reason IS NOT NULL THEN rule_reason
              WHEN NOT degraded AND reputation < 30 THEN 'low author reputation'
              ELSE 'passed all rules' END AS reason,
         coalesce(matched_word, '') AS matched_word,
         degraded
  FROM rep
)"""

RESULTS = f"""
reviews AS (
  SELECT post_id, submitted_ms,
         submitted_ms + {TD.REVIEW_BASE_MS} + (post_id * {TD.REVIEW_SPREAD_MULT}) % {TD.REVIEW_SPREAD_MOD}
           + CASE WHEN post_id % {TD.PARKED_MOD} = {TD.PARKED_REM} THEN {TD.PARKED_DELAY_MS} ELSE 0 END
           AS reviewed_ms
  FROM posts
),
results AS (
  SELECT v.post_id, v.user_id, v.status, v.reason, v.matched_word, v.degraded,
         r.submitted_ms, r.reviewed_ms
  FROM verdicts v JOIN reviews r ON r.post_id = v.post_id
  WHERE r.reviewed_ms <= {TD.AS_OF_MS}
)"""

TASKS = f"""
tasks AS (
  SELECT post_id, user_id, title, content AS content_snapshot, image_count, submitted_ms FROM posts
),
deliveries AS (
  SELECT t.*, CAST(post_id % {TD.PARTITIONS} AS INTEGER) AS "partition", post_id * 2 AS "offset" FROM tasks t
  UNION ALL
  SELECT t.*, CAST(post_id % {TD.PARTITIONS} AS INTEGER) AS "partition", post_id * 2 + 1 AS "offset" FROM tasks t
  WHERE post_id % {TD.REDELIVERY_MOD} = {TD.REDELIVERY_REM}
)"""

REQUESTS = """
requests AS (
  SELECT event_id AS request_id, user_id AS key, epoch_ms(ts) AS t_ms,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 202
              WHEN event_type = 'signup' THEN 429 ELSE 500 END AS http_status,
         value AS latency_ms
  FROM events
)"""

LOOKUPS = """
lookups AS (
  SELECT user_id, epoch_ms(ts) AS t_ms, event_type IN ('error', 'signup', 'purchase') AS failed
  FROM events
)"""

FLAGSHIP_CTES = [POSTS, USERS, WORDS, JUDGED, VERDICTS]
RESULT_CTES = FLAGSHIP_CTES + [RESULTS]


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body
