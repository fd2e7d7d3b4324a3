"""Dedup, apply, violations, reputation, feed, lookup; ordered aggregates; rate limiter."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sifter.operators import intervals, reports
from sifter.operators import results as res
from sifter.operators import ordered
from sifter.operators.ordered import heavy_keys, running_agg
from sifter.operators import ratelimit
from sifter.operators.ratelimit import token_bucket


def test_dedup_first_delivery_wins(spark):
    df = spark.createDataFrame([(1, 0, 5, "b"), (1, 0, 3, "a"), (2, 1, 9, "c"), (1, 1, 0, "z")],
                               "post_id int, partition int, offset int, v string")
    got = {r.post_id: r.v for r in res.dedup_deliveries(df).collect()}
    assert got == {1: "a", 2: "c"}


def test_apply_results_last_wins_unknown_ignored_idempotent(spark):
    posts = spark.createDataFrame([(1, "pending"), (2, "pending"), (3, "approved")],
                                  "post_id int, review_status string")
    ev = spark.createDataFrame([(1, "rejected", 0, 1), (1, "approved", 0, 2), (9, "rejected", 0, 3)],
                               "post_id int, status string, partition int, offset int")
    once = res.apply_results(posts, ev)
    twice = res.apply_results(once, ev)
    expect = {1: "approved", 2: "pending", 3: "approved"}
    assert {r.post_id: r.review_status for r in once.collect()} == expect
    assert {r.post_id: r.review_status for r in twice.collect()} == expect


def test_violations_and_reputation(spark):
    results = spark.createDataFrame([(1, 10, "rejected"), (1, 10, "rejected"), (1, 11, "rejected"),
                                     (2, 12, "approved"), (3, 13, "rejected")],
                                    "user_id int, post_id int, status string")
    v = res.violations(results)
    assert {r.user_id: r.violations for r in v.collect()} == {1: 2, 3: 1}
    users = spark.createDataFrame([(1, 80, 0), (2, 55, 3), (3, 80, 8)],
                                  "user_id int, reputation int, violation_count int")
    got = {r.user_id: (r.reputation, r.violation_count) for r in res.update_reputation(users, v).collect()}
    # user 2: no new violation -> unchanged though off-formula; user 3: 9 violations -> floor 0
    assert got == {1: (60, 2), 2: (55, 3), 3: (0, 9)}


@pytest.mark.parametrize("limit,expect", [(0, 20), (-1, 20), (101, 20), ("abc", 20), (None, 20), (50, 50),
                                          (100, 100), ("7", 7), ("+7", 7), ("1_0", 20), (" 5 ", 20),
                                          ("\u0663", 20), ("", 20)])
def test_feed_limit(limit, expect):
    assert res.feed_limit(limit) == expect


def test_feed_and_lookup(spark):
    posts = spark.createDataFrame([(i, "approved" if i % 2 else "pending") for i in range(100)],
                                  "post_id bigint, review_status string")
    feed = [r.post_id for r in res.approved_feed(posts, 5).collect()]
    assert feed == [99, 97, 95, 93, 91]
    plan = res.approved_feed(posts, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    ids = spark.createDataFrame([(2,), (3,), (500,)], "post_id bigint")
    got = {r.post_id: (r.found, r.review_status) for r in res.status_lookup(posts, ids).collect()}
    assert got == {2: (True, "pending"), 3: (True, "approved"), 500: (False, None)}
    view = spark.createDataFrame([(2, "rejected")], "post_id bigint, status string")
    cached = {r.post_id: r.review_status for r in res.status_lookup(posts, ids, view=view).collect()}
    assert cached == {2: "rejected", 3: "approved", 500: None}  # the live cache entry is read first


def test_running_agg_equals_plain_window_with_hot_key(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.4 else rng.randint(1, 20), rng.randint(0, 5000), i, rng.randint(0, 1))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, id int, v int")
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("s"),
                      F.max("t").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"))
    a = {r.id: (r.s, r.m) for r in plain.collect()}
    hot = heavy_keys(df, ["k"], sample_fraction=1.0, min_rows=1000)
    assert [r.k for r in hot.collect()] == [0]  # the key with 40% of the rows
    for h in (None, hot):  # default (no key big enough to split) and split heavy key
        s = running_agg(df, ["k"], ["t", "id"], "v", "s", F.floor(F.col("t") / 97), fn="sum", hot=h)
        m = running_agg(df, ["k"], ["t", "id"], "t", "m", F.floor(F.col("t") / 97), fn="max", hot=h)
        b = {r.id: r.s for r in s.collect()}
        c = {r.id: r.m for r in m.collect()}
        assert {i: (b[i], c[i]) for i in a} == a


def _bucket_reference(rows, q, unit, burst, cost):
    out, state = {}, {}
    for key, t, rid in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        b, c = burst * unit, cost * unit
        if key not in state:
            tokens = b
        else:
            tokens, ts = state[key]
            tokens = min(b, tokens + max(0, t - ts) * q)
        ok = tokens >= c
        if ok:
            tokens -= c
        state[key] = (tokens, t)
        out[rid] = ok
    return out


@pytest.mark.parametrize("q,unit,burst,cost,cell_rows", [(200, 1000, 400, 1, 10**6), (1, 50, 3, 1, 50), (3, 10, 2, 2, 300), (5, 10, 1, 3, 100)])
def test_token_bucket_matches_sequential_fold(spark, q, unit, burst, cost, cell_rows):
    rng = random.Random(q + unit)
    rows = []
    for i in range(4000):
        key = "hot" if rng.random() < 0.5 else None if rng.random() < 0.2 else f"k{rng.randint(0, 9)}"
        t = rng.randint(0, 20000) if rng.random() < 0.9 else rng.randint(0, 20000) * 50
        rows.append((key, t, i))
    df = spark.createDataFrame(rows, "key string, t_ms long, request_id long")
    got = {r.request_id: r.admitted for r in token_bucket(df, tokens_per_period=q, period_ms=unit,
                                                          burst=burst, cost=cost, cell_rows=cell_rows).collect()}
    assert got == _bucket_reference([(k or "", t, i) for k, t, i in rows], q, unit, burst, cost)


def _peaks(peak, trough, cycles, up, down):
    """One key: ``peak`` requests ``up`` ms apart, then ``trough`` requests ``down`` ms apart, again and again."""
    rows, t = [], 0
    for _ in range(cycles):
        for n, gap in ((peak, up), (trough, down)):
            for _ in range(n):
                t += gap
                rows.append(("post:create", t, len(rows)))
    return rows


@pytest.mark.parametrize("name,limit", [("load, overload, pauses", (50, 1000, 20, 1)), ("contiguous peaks", (1, 1000, 20, 1)),
                                        ("never full", (1, 1000, 3, 1)), ("a cost that does not divide", (7, 30, 5, 3))])
def test_no_task_folds_more_than_a_cell_of_a_busy_key(spark, monkeypatch, name, limit):
    """One key in cells of about 100 rows: each pass folds cells only, and the answers equal the fold of the whole key."""
    rng = random.Random(4)
    if name == "contiguous peaks":  # 10/s, then 0.67/s against 1/s: no pause refills the bucket
        rows = _peaks(400, 600, 3, 100, 1500)
    elif name == "never full":
        rows = _peaks(300, 300, 4, 250, 1001)
    else:
        rows, t = [], 0
        for i in range(3000):
            t += rng.choice([0, 1, 4, 30] if (i // 300) % 2 else [3, 6, 9, 200])
            rows.append(("post:create", t, i))
    q, unit, burst, cost = limit
    df = spark.createDataFrame(rows, "key string, t_ms long, request_id long")
    tables = {}

    def keep(frame, kind, real=ratelimit.write_and_read):
        tables[kind] = real(frame, kind)
        return tables[kind]

    monkeypatch.setattr(ratelimit, "write_and_read", keep)
    out = token_bucket(df, tokens_per_period=q, period_ms=unit, burst=burst, cost=cost, cell_rows=100).collect()
    got = {r.request_id: r.admitted for r in out}
    expect = _bucket_reference(rows, q, unit, burst, cost)
    assert got == expect and 0 < sum(expect.values()) < len(rows)
    sizes = [r["count"] for r in tables["requests"].groupBy("_cell").count().collect()]
    assert len(sizes) >= len(rows) / 200 and max(sizes) <= 300
    assert tables["levels"].count() == len(sizes)


def test_phase_maps_compose_as_the_single_steps_do():
    rng = random.Random(3)
    for cost in (1, 2, 10, 97):
        for _ in range(60):
            steps = [(rng.random() < 0.5, rng.randint(0, cost - 1)) for _ in range(rng.randint(0, 12))]
            m = ratelimit.PhaseMap(cost)
            for cut, x in steps:
                (m.cut if cut else m.turn)(x)
            starts, values, grows = zip(*m.settled())
            for phase in range(cost):
                expect = phase
                for cut, x in steps:
                    expect = min(expect, x) if cut else (expect + x) % cost
                assert ratelimit.apply_phase(starts, values, grows, phase) == expect


def test_token_bucket_burst_cap(spark):
    df = spark.createDataFrame([("post:create", 0, i) for i in range(1000)], "key string, t_ms long, request_id long")
    n = token_bucket(df).where("admitted").count()
    assert n == 400


def test_rank_percentiles_exact(spark):
    rng = random.Random(9)
    vals = [(rng.choice("ab"), round(rng.random() * 300, 2)) for _ in range(2000)] + [("a", 5.0)] * 50
    df = spark.createDataFrame(vals, "g string, v double")
    got = {r.g: (r.n, r.p50, r.p90, r.p99) for r in reports.rank_percentiles(df, "v", [0.5, 0.9, 0.99],
                                                                              by=["g"]).collect()}
    for g in "ab":
        xs = sorted(v for gg, v in vals if gg == g)
        n = len(xs)
        exp = tuple(xs[min(int(p * n), n - 1)] for p in (0.5, 0.9, 0.99))
        assert got[g] == (n,) + exp


def test_rank_percentiles_keep_null_groups_and_spread_an_outlier(spark):
    rng = random.Random(2)
    vals = [(rng.choice(["a", None]), rng.random()) for _ in range(5000)] + [("a", 1e12)]
    df = spark.createDataFrame(vals, "g string, v double").repartition(4)
    got = {r.g: (r.n, r.p50, r.m) for r in reports.rank_percentiles(df, "v", [0.5], by=["g"], max_alias="m").collect()}
    for g in ("a", None):
        xs = sorted(v for gg, v in vals if gg == g)
        assert got[g] == (len(xs), xs[len(xs) // 2], xs[-1])
    # equal depth: no band holds most of the distinct values
    counts = df.groupBy("v").count().repartitionByRange(8, "v").groupBy(F.spark_partition_id().alias("b")).count()
    assert max(r["count"] for r in counts.collect()) < 2000


def test_rank_percentiles_shuffle_values_near_the_ranks_only(spark):
    """Values far from a wanted rank are counted, not kept; the answers are those of a sort."""
    from sifter.operators.reports import _near_ranks

    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), (F.xxhash64("id") % 10**9).cast("double").alias("v"))
    kept = _near_ranks(df, "v", [0.5, 0.99], ["g"])
    assert kept.count() < 2000 and kept.agg(F.sum("_c")).first()[0] == 200_000
    got = {r.g: (r.n, r.p50, r.p99, r.m) for r in reports.rank_percentiles(df, "v", [0.5, 0.99], by=["g"], max_alias="m").collect()}
    for g, rows in df.toPandas().groupby("g"):
        xs = sorted(rows["v"])
        assert got[g] == (len(xs), xs[int(0.5 * len(xs))], xs[int(0.99 * len(xs))], xs[-1])


def test_rank_percentiles_when_the_sketch_misses(spark, monkeypatch):
    """A rank outside its pair of values (here: pairs around other ranks) is seen, and all values are ranked."""
    monkeypatch.setattr(reports, "SKETCH_MARGIN", -0.05)
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    assert reports.rank_percentiles(df, "v", [0.5, 0.9], max_alias="m").first()[:] == (1000, 500, 900, 999)


def test_rank_percentiles_of_wide_numbers_no_numbers_and_nothing(spark):
    big = 2**62  # neighbours are one double
    df = spark.range(101).select((F.lit(big) + F.col("id")).alias("v"), F.format_string("%04d", "id").alias("s"))
    assert reports.rank_percentiles(df, "v", [0.5, 1.0]).first()[:] == (101, big + 50, big + 100)
    assert reports.rank_percentiles(df, "s", [0.5], max_alias="m").first()[:] == (101, "0050", "0100")
    empty = df.where("v < 0")
    assert reports.rank_percentiles(empty, "v", [0.5], by=["s"]).count() == 0
    assert reports.rank_percentiles(empty, "v", [0.5]).count() == reports.rank_percentiles(empty, "s", [0.5]).count()


def test_outage_windows_strict_ratio(spark):
    rows = [(1, 10, True)] * 3 + [(1, 20, False)] * 2 + [(2, 60_010, True)] * 4 + [(2, 60_020, False)] * 1
    df = spark.createDataFrame(rows, "user_id int, t_ms long, failed boolean")
    got = [(r.window_start_ms, r.n, r.failures) for r in reports.outage_windows(df, 60_000).collect()]
    assert got == [(60_000, 5, 4)]  # 3/5 = 0.6 is not > 0.6


def test_degraded_during_range_join(spark):
    res_df = spark.createDataFrame([(1, 5_000, True), (2, 7_000, True), (3, 7_000, False), (4, 20_000, True)],
                                   "post_id int, reviewed_ms long, degraded boolean")
    outages = spark.createDataFrame([(4_000, 9_000), (19_000, 20_000)], "window_start_ms long, window_end_ms long")
    got = sorted(r.post_id for r in reports.degraded_during(res_df, outages).collect())
    assert got == [1, 2]


@pytest.mark.parametrize("part_rows", [5, 10**6])
def test_points_in_intervals_of_any_length_and_overlap(spark, part_rows):
    rng = random.Random(part_rows)
    big = 2 ** 60
    points = [(big + i, rng.choice([None, 500, 500, rng.randint(0, 1000)])) for i in range(300)]
    windows = [(a, a + rng.choice([0, 1, 5, 100, 10**7, -3])) for a in (rng.randint(-100, 1100) for _ in range(60))]
    windows += [(-10**12, 10**12), (500, 501), (500, 501), (None, 5), (5, None)]
    got = intervals.points_in_intervals(spark.createDataFrame(points, "_id long, _t long"),
                                        spark.createDataFrame(windows, "_start long, _end long"), part_rows).collect()
    expect = [(i, t, a, b) for i, t in points for a, b in windows if t is not None and a is not None and b is not None and a <= t < b]
    assert sorted(tuple(r) for r in got) == sorted(expect)


def test_a_year_long_window_is_a_row_per_part_and_a_hot_hour_many_parts(spark, monkeypatch):
    tables = {}

    def keep(frame, kind, real=intervals.write_and_read):
        tables[kind] = real(frame, kind)
        return tables[kind]

    monkeypatch.setattr(intervals, "write_and_read", keep)
    points = spark.range(4000).select(F.col("id").alias("_id"), F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("_t"))
    year = spark.createDataFrame([(0, 365 * 86_400_000)], "_start long, _end long")
    out = intervals.points_in_intervals(points, year, part_rows=100)
    assert out.count() == 4000
    sizes = [r["count"] for r in tables["points"].groupBy("_part").count().collect()]
    assert len(sizes) >= 30 and max(sizes) <= 300


def test_no_points_and_no_intervals(spark):
    none = spark.createDataFrame([], "_id long, _t long")
    some = spark.createDataFrame([(1, 5)], "_id long, _t long")
    assert intervals.points_in_intervals(none, some.toDF("_start", "_end")).count() == 0
    assert intervals.points_in_intervals(some, spark.createDataFrame([], "_start long, _end long")).count() == 0


def test_large_keys_and_ids_stay_whole_beside_null_keys(spark):
    big = 2 ** 62 + 1
    rows = [(big + i % 2 if i % 3 else None, i // 4, big + i) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, t_ms long, request_id long")
    out = token_bucket(df, tokens_per_period=1, period_ms=10, burst=3, cell_rows=40).collect()
    assert {r.request_id: r.admitted for r in out} == _bucket_reference([(k or 0, t, i) for k, t, i in rows], 1, 10, 3, 1)
    assert {r.key for r in out} == {big, big + 1, None}


def test_latency_per_post(spark):
    tasks = spark.createDataFrame([(1, 1000), (2, 2000), (3, 3000)], "post_id long, ms long") \
        .withColumn("submitted_at", F.timestamp_millis("ms"))
    res_df = spark.createDataFrame([(1, 1076), (2, 2306)], "post_id long, reviewed_ms long")
    got = {r.post_id: r.latency_ms for r in reports.latency_per_post(tasks, res_df).collect()}
    assert got == {1: 76, 2: 306}


def test_reenqueue_tasks_for_stuck_posts(spark):
    posts = spark.createDataFrame([(1, 7, "t1", "c1", 0, 1000, "pending"), (2, 7, "t2", "c2", 3, 1000, "pending"),
                                   (3, 7, "t3", "c3", 0, 9000, "pending"), (4, 7, "t4", "c4", 0, 1000, "approved")],
                                  "post_id long, user_id long, title string, content string, image_count int, "
                                  "submitted_ms long, review_status string")
    results = spark.createDataFrame([(1, "approved")], "post_id long, status string")
    t = reports.reenqueue_tasks(posts, results, as_of_ms=10_000, age_ms=5_000).collect()
    # post 1 has a result, post 3 is too young, post 4 is not pending: only post 2 goes again
    assert [(r.post_id, r.content_snapshot, r.image_count) for r in t] == [(2, "c2", 3)]


def test_request_times_do_not_depend_on_session_zone(spark):
    from conftest import SF_SMALL
    from sifter.sources import testdata as TD

    utc = [r.t_ms for r in TD.requests(spark, SF_SMALL).orderBy("request_id").limit(50).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = [r.t_ms for r in TD.requests(spark, SF_SMALL).orderBy("request_id").limit(50).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == ny
