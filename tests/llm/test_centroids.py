import hashlib
import math
import random

import numpy as np
import pytest

from sifter.llm import centroids as cc


def brute(rows, dims=64, k=8, scale=1024, rounds=10, seed=3):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c))

    for _ in range(rounds):
        got = [near(v)[1] for _, v in kept]
        for n in range(len(c)):
            mine = [v for (_, v), g in zip(kept, got) if g == n]
            if mine:
                c[n] = [sum(col) // len(mine) for col in zip(*mine)]
    placed = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in placed)
    return sorted((str(i), n, d, sum(e for _, e, m in placed if m == n), total,
                   hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for i, d, n in placed)


def check(spark, rows, kind="float", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, cluster string").repartition(3)
    got = cc.cluster_vectors(df, **options).collect()
    plain = [(i, v) if kind == "double" else (i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == \
        brute(plain, **options)


def test_random_vectors_with_many_ties(spark):
    rng = random.Random(4)
    check(spark, [(i, [rng.gauss(0, 0.3) for _ in range(5)], "x") for i in range(300)], dims=5)
    check(spark, [(i, [rng.randint(-2, 2) / 1024 for _ in range(2)], "x") for i in range(400)], dims=2, k=7)
    check(spark, [(i, [rng.randint(0, 1) / 1024 for _ in range(3)], "x") for i in range(100)], dims=3, k=13, rounds=3)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5, -1.0]
    rows = [(0, good, "a"), (1, None, "a"), (2, [None, 1.0], "a"), (3, [nan, 1.0], "a"), (4, [inf, 0.0], "a"), (None, [1.0, 2.0], "a"),
            (5, [], "a"), (6, [1.0], "a"), (7, [1.0, 1.0, 1.0], "a"), (8, good, None), (8, good, "b"), (8, [0.0, 0.0], "b")]
    check(spark, rows, dims=2)
    check(spark, rows, dims=2, k=2)
    check(spark, [(i, good, "a") for i in range(20)], dims=2)
    check(spark, [(None, [0.1 * i, 1.0], "a") for i in range(3)], dims=2, k=2)
    assert cc.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_large_components_stay_exact_and_larger_ones_are_refused(spark):
    rng = random.Random(1)
    check(spark, [(i, [rng.uniform(-40000, 40000) for _ in range(64)], "x") for i in range(15)], "double")
    with pytest.raises(ValueError, match="inertia"):
        cc.cluster_vectors(spark.createDataFrame([(i, [rng.choice([-131072.0, 131071.0]) for _ in range(64)]) for i in range(40)],
                                                 "vec_id long, embedding array<double>"))
    df = spark.createDataFrame([(1, [131073.0] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="131072"):
        cc.cluster_vectors(df)


def test_a_tournament_is_k_minus_1_tests_and_zero_favours_the_smaller_number(monkeypatch):
    c = np.array([[0, 0], [4, 0], [0, 4], [4, 4], [0, 0], [9, 9], [2, 2]])
    t = cc.Tournament(c)
    x = np.array([[2, 0], [2, 2], [0, 0], [4, 2], [9, 9], [3, 3]])
    tests = []
    play = cc.Tournament._play
    monkeypatch.setattr(cc.Tournament, "_play", staticmethod(lambda v, *a: tests.append(len(v)) or play(v, *a)))
    assert t.winners(x).tolist() == [0, 6, 0, 1, 5, 3]
    assert tests == [len(x)] * (len(c) - 1)
    big = x.astype(np.int64) << 26
    assert cc.Tournament(c << 26).winners(big).tolist() == [0, 6, 0, 1, 5, 3]


def test_only_sums_reach_the_driver(spark, monkeypatch):
    rows = [(i, [float(i % 10), 1.0]) for i in range(1000)]
    whole = cc.kept_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 2, 1).repartition(20)
    got = cc._sums(whole, np.array([[0, 1], [9, 1]]))
    assert sorted(got) == [(0, [500, 1000, 500]), (1, [500, 3500, 500])]
