"""T1, T2 over a table that is laid out by post id: point reads and the newest page without a scan.

Post statuses are kept in a state table: files sorted by post id, whose ids'
ranges and filters are in the manifest.  A creation or a result adds a row and
the last one per post counts.

* **T2**: asked ids open only the files whose range and filter admit one of them.
* **T1**: the feed reads from the largest ids downwards, first the files that reach into
  the newest ranges, then twice as many, until the page is full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.operators.results import approved_feed, feed_limit, status_lookup
from sifter.streaming.state import StateTable

STATUS_SCHEMA = "post_id bigint, review_status string"
FIRST_RANGES = 4  # file ranges that the feed reads first


def _last(rows: DataFrame) -> DataFrame:
    return rows.groupBy("post_id").agg(F.max_by("review_status", "_seq").alias("review_status"))


def status_table(spark: SparkSession, path: str, **options) -> StateTable:
    """The statuses at ``path``, by post id."""
    return StateTable(spark, path, STATUS_SCHEMA, "post_id", _last, **options)


def put_statuses(table: StateTable, rows: DataFrame, run: str, batch_id: int) -> None:
    """Add ``rows`` (post_id, review_status), one per post; writing a batch again replaces it."""
    table.begin(run, batch_id)
    table.append(run, batch_id, rows, None)


def lookup(table: StateTable, ids: DataFrame, id_col: str = "post_id", view: DataFrame | None = None) -> DataFrame:
    """As :func:`sifter.operators.results.status_lookup`, from the files that may have the ids."""
    asked = ids.select(F.col(id_col).alias("post_id"))
    return status_lookup(table.read(asked), asked, view=view)


def newest_approved(table: StateTable, limit=K.FEED_DEFAULT_LIMIT) -> DataFrame:
    """As :func:`sifter.operators.results.approved_feed`, from the newest file ranges that fill the page."""
    lows = sorted({f["min"] for s in table.manifest()["segments"] for f in s["files"] if f["min"] is not None}, reverse=True)
    ranges = FIRST_RANGES
    while ranges < len(lows):
        page = approved_feed(table.read_from(lows[ranges - 1]), limit).collect()  # a page at most
        if len(page) == feed_limit(limit):
            return table.spark.createDataFrame(page, STATUS_SCHEMA)
        ranges *= 2
    return approved_feed(table.read(), limit)
