"""Status view and status table in segments: expiry, reads as of the past, pruned lookups and pages."""

import os

import pytest
from pyspark.sql import functions as F

from sifter.operators import results as res
from sifter.streaming import status_view as sv
from sifter.streaming.status_table import lookup, newest_approved, put_statuses, status_table

MINUTE = 60_000
DAY = sv.HISTORY_MS


def entry(spark, rows):
    return spark.createDataFrame(rows, "post_id bigint, status string, written_ms bigint")


def live(spark, view, as_of):
    return {r.post_id: (r.status, r.updated_ms) for r in sv.read_status_view(spark, view, as_of).collect()}


def expected(writes, as_of):
    out = {}
    for post, status, at in writes:
        if as_of - 10 * MINUTE < at <= as_of and (post not in out or at >= out[post][1]):
            out[post] = (status, at)
    return out


def test_view_over_many_batches(spark, scratch):
    """Few segments, merged ones among them; right as of now and as of earlier times."""
    view, writes = os.path.join(scratch, "view"), []
    table = sv.view_table(spark, view, "applied", fanout=3)
    for b in range(10):
        rows = [(p, f"s{b}", b * 3 * MINUTE) for p in (b % 4, 100 + b)]
        writes += rows
        sv.write_entries(entry(spark, rows), table, b, run="r")
    segments = table.manifest()["segments"]
    assert len(segments) <= 6 and any(s["level"] > 0 for s in segments)
    for as_of in (0, 5 * MINUTE, 14 * MINUTE, 27 * MINUTE, 90 * MINUTE):
        assert live(spark, view, as_of) == expected(writes, as_of), as_of


def test_expired_entries_go_and_are_not_guessed(spark, scratch):
    view = os.path.join(scratch, "view")
    table = sv.view_table(spark, view, "applied", fanout=2)
    for b, at in enumerate((0, 1, 3 * DAY, 3 * DAY + 1, 3 * DAY + 2)):
        sv.write_entries(entry(spark, [(b, "approved", at)]), table, b, run="r")
    m = table.manifest()
    assert sum(s["rows"] for s in m["segments"]) == 3 and m["gone"] > 0
    assert set(live(spark, view, 3 * DAY + 2)) == {2, 3, 4} and set(live(spark, view, 3 * DAY)) == {2}
    with pytest.raises(ValueError, match="are gone"):
        sv.read_status_view(spark, view, 5)


def test_view_replay_replaces_its_batch(spark, scratch):
    view = os.path.join(scratch, "view")
    table = sv.view_table(spark, view, "applied")
    sv.write_entries(entry(spark, [(1, "approved", 5)]), table, 0, run="r")
    sv.write_entries(entry(spark, [(1, "rejected", 7), (2, "rejected", 7)]), table, 1, run="r")
    sv.write_entries(entry(spark, [(1, "pending", 6)]), table, 1, run="r")
    assert live(spark, view, 100) == {1: ("pending", 6)}


def test_empty_and_null(spark, scratch):
    view = os.path.join(scratch, "view")
    table = sv.view_table(spark, view, "applied")
    sv.write_entries(entry(spark, []), table, 0, run="r")
    assert live(spark, view, 100) == {}
    sv.write_entries(entry(spark, [(None, "approved", 5), (3, None, 5)]), table, 1, run="r")
    assert live(spark, view, 100) == {None: ("approved", 5), 3: (None, 5)}


@pytest.fixture
def clustered(spark, scratch):
    """20,000 posts in batches that overlap; a later batch changes the statuses of some."""
    table = status_table(spark, os.path.join(scratch, "statuses"), filter_rows=100, file_rows=2500)
    for b in range(8):
        ids = spark.range(b * 2500, (b + 1) * 2500).withColumnRenamed("id", "post_id")
        put_statuses(table, ids.withColumn("review_status", F.when(F.col("post_id") % 3 == 0, "approved").otherwise("pending")), "created", b)
    late = spark.range(0, 20000, 500).select(F.col("id").alias("post_id"), F.lit("rejected").alias("review_status"))
    put_statuses(table, late, "applied", 0)
    plain = spark.range(20000).select(F.col("id").alias("post_id"), F.when(F.col("id") % 500 == 0, "rejected").when(
        F.col("id") % 3 == 0, "approved").otherwise("pending").alias("review_status"))
    return table, plain


def test_lookup_opens_few_files(spark, clustered):
    table, plain = clustered
    ids = spark.createDataFrame([(5001,), (5500,), (5001,), (10**9,), (None,)], "post_id bigint")
    got = sorted(lookup(table, ids).collect(), key=str)
    assert got == sorted(res.status_lookup(plain, ids).collect(), key=str)
    table.read(ids.where("post_id < 10000"))
    every = sum(len(s["files"]) for s in table.manifest()["segments"])
    assert len(table.opened) < every


@pytest.mark.parametrize("limit", [1, 20, 100])
def test_feed_reads_the_newest_ranges(spark, clustered, limit, monkeypatch):
    from sifter.streaming import status_table as mod

    monkeypatch.setattr(mod, "FIRST_RANGES", 1)
    table, plain = clustered
    got = [r.post_id for r in newest_approved(table, limit).collect()]
    assert got == [r.post_id for r in res.approved_feed(plain, limit).collect()]


def test_feed_of_few_approved_reads_on(spark, scratch):
    table = status_table(spark, os.path.join(scratch, "statuses"))
    for b in range(6):
        rows = [(b * 10 + k, "approved" if b == 0 else "pending") for k in range(3)] + ([(None, "approved")] if b == 5 else [])
        put_statuses(table, spark.createDataFrame(rows, "post_id bigint, review_status string"), "created", b)
    assert [r.post_id for r in newest_approved(table, 20).collect()] == [2, 1, 0, None]
    assert newest_approved(status_table(spark, os.path.join(scratch, "none")), 20).collect() == []
