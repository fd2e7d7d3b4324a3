"""State that outlives micro-batches: merges by size, replays, pruned reads; the token bucket as a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sifter.operators.idfilter import build_filter, may_contain, words_for
from sifter.streaming import admission_stream as adm
from sifter.streaming import state as st
from sifter.sources.stream import read_tasks_stream  # noqa: F401
from test_results import _bucket_reference


def last(rows):
    return rows.groupBy("k").agg(F.max_by("v", "_seq").alias("v"))


def table(spark, path, **options):
    return st.StateTable(spark, path, "k bigint, v string", "k", last, **options)


def contents(t, **options):
    return {r.k: r.v for r in t.read(**options).collect()}


def put(spark, t, run, batch, rows):
    t.begin(run, batch)
    t.append(run, batch, spark.createDataFrame(rows, "k bigint, v string"), len(rows))


def test_a_thousand_batches_leave_few_segments():
    segments, seq = [], 0
    for _ in range(1000):
        while groups := st.due_merges(segments, 8):
            for some in groups:
                segments = [s for s in segments if s not in some] + [{"level": some[0]["level"] + 1, "id": max(s["id"] for s in some),
                                                                      "rows": sum(s["rows"] for s in some)}]
        seq += 1
        segments.append({"level": 0, "id": seq, "rows": 1})
        assert sum(s["rows"] for s in segments) == seq
    assert len(segments) <= 8 * 4


def test_batches_merge_and_the_latest_row_wins(spark, scratch):
    t, expect, rng = table(spark, scratch, fanout=3, file_rows=4, filter_rows=8), {}, random.Random(1)
    for batch in range(14):
        rows = {rng.choice([None, *range(12)]): f"b{batch}" for _ in range(5)}
        expect.update(rows)
        put(spark, t, "q", batch, list(rows.items()))
    assert contents(t) == expect
    segments = t.manifest()["segments"]
    assert len(segments) <= 6 and max(s["level"] for s in segments) == 2
    assert all(f["rows"] <= 8 for s in segments for f in s["files"])
    # nothing is left of what has been merged, but for the last two manifests' segments
    assert len(os.listdir(f"{scratch}/data")) <= len(segments) + 4 and len(os.listdir(f"{scratch}/manifest")) <= 8
    some = spark.createDataFrame([(3,), (None,), (99,)], "k bigint")
    assert contents(t, keys=some) == {k: v for k, v in expect.items() if k in (3, None)}


def test_replay_drops_the_first_attempt_and_other_runs_stay(spark, scratch):
    t = table(spark, scratch, fanout=2)
    put(spark, t, "old", 0, [(1, "old"), (2, "old")])
    put(spark, t, "new", 0, [(1, "new 0")])
    put(spark, t, "new", 1, [(2, "first attempt"), (3, "first attempt")])
    put(spark, t, "new", 1, [(2, "second attempt")])
    assert contents(t) == {1: "new 0", 2: "second attempt"}
    assert {s["run"] for s in t.manifest()["segments"]} >= {"new"}


def test_a_crash_in_mid_merge_loses_nothing(spark, scratch, monkeypatch):
    t = table(spark, scratch, fanout=2)
    put(spark, t, "q", 0, [(1, "a"), (2, "a")])
    put(spark, t, "q", 1, [(2, "b"), (3, "b")])

    def crash(self, manifest):
        raise RuntimeError("crash after the merged files, before the manifest")

    with monkeypatch.context() as m:
        m.setattr(st.StateTable, "_commit", crash)
        with pytest.raises(RuntimeError, match="crash"):
            t.begin("q", 2)
    assert contents(t) == {1: "a", 2: "b", 3: "b"}
    put(spark, t, "q", 2, [(4, "c")])
    assert contents(t) == {1: "a", 2: "b", 3: "b", 4: "c"}
    t.begin("q", 3)
    assert set(os.listdir(f"{scratch}/data")) >= {s["id"] for s in t.manifest()["segments"]}


def test_a_checkpoint_older_than_merged_state_is_refused(spark, scratch):
    t = table(spark, scratch, fanout=2)
    for batch in range(3):
        put(spark, t, "q", batch, [(batch, "x")])
    with pytest.raises(RuntimeError, match="older"):
        t.begin("q", 1)


def test_an_old_key_opens_only_files_that_may_hold_it(spark, scratch):
    t = table(spark, scratch, fanout=100, file_rows=50, filter_rows=0)
    for batch in range(6):  # even ids only, so that ranges alone would admit odd ones
        put(spark, t, "q", batch, [(2 * i, "x") for i in range(200 * batch, 200 * batch + 200)])
    every = sum(len(s["files"]) for s in t.manifest()["segments"])
    assert every >= 20
    assert contents(t, keys=spark.createDataFrame([(10,), (2390,)], "k bigint")) == {10: "x", 2390: "x"}
    assert 2 <= len(t.opened) <= 4
    assert contents(t, keys=spark.createDataFrame([(11,), (2391,)], "k bigint")) == {}
    assert len(t.opened) <= 1
    assert contents(t, keys=spark.createDataFrame([(10**9,)], "k bigint")) == {} and not t.opened


def test_the_filter_never_denies_an_id_and_rarely_admits_another(spark):
    ids = spark.range(0, 40000, 2).union(spark.range(1))
    words = words_for(20000)
    f = build_filter(ids, "id", words)
    assert f.count() <= words
    hits = {r.id for r in may_contain(spark.range(0, 40000), "id", f, words).collect()}
    assert hits >= set(range(0, 40000, 2)) and len(hits) < 20000 * 1.1
    plan = may_contain(spark.range(0, 40000), "id", f, words)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def _run(spark, scratch, parts, **limit):
    src, out, state = (os.path.join(scratch, p) for p in ("src", "out", "state"))
    schema = "request_id bigint, key string, t_ms bigint"
    for part in parts:  # each lands after the query before has stopped: a restart between batches
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        adm.admission_stream(spark, stream, out, state, checkpoint=os.path.join(scratch, "ckpt"), **limit).awaitTermination()
    return {r.request_id: r.admitted for r in spark.read.parquet(out).collect()}


def test_admission_stream_equals_the_fold_over_restarts_and_late_requests(spark, scratch):
    rng, parts, state, expect = random.Random(2), [], {}, {}
    b, c, q, t = 3 * 50, 50, 1, 0
    for p in range(5):
        rows = []
        for i in range(150):
            t += rng.choice([0, 5, 20, 200])
            late = rng.choice([0, 0, 0, 400]) if p else 0
            rows.append((p * 1000 + i, rng.choice(["hot", "hot", "a", "b", None, f"n{p}"]), max(0, t - late)))
        parts.append(rows)
        known = {k: ts for k, (_, ts) in state.items()}
        for rid, k, at in sorted(rows, key=lambda r: (max(r[2], known.get(r[1], 0)), r[0])):
            at = max(at, known.get(k, 0))
            tokens, ts = state.get(k, (b, at))
            tokens = min(b, tokens + (at - ts) * q)
            expect[rid] = tokens >= c
            state[k] = (tokens - c * expect[rid], at)
    got = _run(spark, scratch, parts, tokens_per_period=q, period_ms=50, burst=3, cell_rows=20)
    assert got == expect and 0 < sum(got.values()) < len(got)


def test_admission_in_order_is_the_batch_answer(spark, scratch):
    rng, rows, t = random.Random(7), [], 0
    for i in range(600):
        t += rng.choice([0, 1, 30, 90])
        rows.append((i, rng.choice("xyz"), t))
    got = _run(spark, scratch, [rows[:200], rows[200:450], rows[450:]], tokens_per_period=2, period_ms=50, burst=2)
    assert got == _bucket_reference([(k, at, i) for i, k, at in rows], 2, 50, 2, 1)


def test_a_replayed_batch_gives_the_same_answers_and_state(spark, scratch):
    out, state = os.path.join(scratch, "out"), os.path.join(scratch, "state")
    batches = [spark.createDataFrame([(10 * b + i, "k", 100 * b + i) for i in range(8)], "request_id bigint, key string, t_ms bigint") for b in range(3)]
    limit = dict(tokens_per_period=1, period_ms=20, burst=4)

    def answers():
        return sorted((r.request_id, r.admitted, r.tokens_left) for r in spark.read.parquet(out).collect())

    def buckets():
        return sorted(tuple(r) for r in adm.bucket_table(spark, state, "string").read().collect())

    for b in (0, 1):
        adm.admit_batch(spark, batches[b], b, out, state, **limit)
    once, left = answers(), buckets()
    adm.admit_batch(spark, batches[1], 1, out, state, **limit)  # the batch runs again after a crash
    assert (answers(), buckets()) == (once, left)
    adm.admit_batch(spark, batches[2], 2, out, state, **limit)
    rows = [("k", 100 * b + i, 10 * b + i) for b in range(3) for i in range(8)]
    assert {i: a for i, a, _ in answers()} == _bucket_reference(rows, 1, 20, 4, 1)
