import random
import re

import numpy as np
import pyarrow as pa
import xxhash
import pytest

from sifter.llm import simhash as sh
from sifter.llm.components import connected_components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    up = list(range(n))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(a) for a in range(n)]


def check(rows, source):
    fps = [fingerprint(t) for _, t in source]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    root = components(len(fps), near)
    least = {}
    for (k, _), r in zip(source, root):
        if k is not None:
            least[r] = min(k, least.get(r, k))
    expect = sorted((str(k), "%016x" % f, str(least.get(r))) for (k, _), f, r in zip(source, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == expect
    return len(set(root))


def test_whole_table(mid):
    df, source = mid
    assert check(sh.near_duplicates(df).collect(), source) < len(source)


def test_edges(edge_docs, no_docs):
    from .conftest import ROWS

    check(sh.near_duplicates(edge_docs).collect(), ROWS)
    assert sh.near_duplicates(no_docs).count() == 0


def test_one_of_each_stays(spark, edge_docs):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (1, "a b c d", 3), (None, "a b c d", 4), (2, "x y z", 5), (None, "q", 6), (2, "k l m n", 7)]
    kept = sh.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, fp int").coalesce(1))
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(r.fp for r in kept.collect()) == [2, 5, 6, 7]


@pytest.mark.parametrize("bucket_rows", [4096, 12])
def test_links_connect_what_brute_force_does(spark, bucket_rows):
    """Dense clusters, through plain buckets, finer buckets and hubs."""
    rng = np.random.default_rng(1)
    fps = set()
    for base in rng.integers(0, 2 ** 63, 6, dtype=np.uint64):
        for _ in range(25):
            flips = rng.choice(64, int(rng.integers(0, 4)), replace=False)
            fps.add(int(base) ^ sum(1 << int(b) for b in flips))
    fps = sorted(f - 2 ** 64 if f >= 2 ** 63 else f for f in fps)
    at = {f: i for i, f in enumerate(fps)}
    u = [f % 2 ** 64 for f in fps]
    near = [(a, b) for a in range(len(u)) for b in range(a) if bin(u[a] ^ u[b]).count("1") <= 3]
    links = sh.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 3, 4, bucket_rows).collect()
    assert components(len(u), [(at[r.u], at[r.v]) for r in links]) == components(len(u), near)


def test_thresholds_cover_the_distance():
    rng = np.random.default_rng(0)
    for _ in range(20):
        cost = rng.random((4, 5)).cumsum(axis=1)
        got = sh.allocate(cost, 3)
        assert sum(t + 1 for t in got) == 4 and min(got) >= -1
        import itertools
        best = min(sum(cost[i, t + 1] for i, t in enumerate(ts)) for ts in itertools.product(range(-1, 4), repeat=4)
                   if sum(t + 1 for t in ts) == 4)
        assert abs(sum(cost[i, t + 1] for i, t in enumerate(got)) - best) < 1e-9


def test_pair_counts():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 4, 32).astype(float)
    for t in range(3):
        expect = sum(counts[a] * counts[b] for a in range(32) for b in range(32) if bin(a ^ b).count("1") <= t)
        assert abs(sh.pairs_within(counts, t) - expect) < 1e-6


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(3)
    bits = rng.integers(0, 2, (4000, 64))
    bits[:, 40:48] = bits[:, 8:16]
    both = bits.T @ bits
    parts = sh.group_bits(4000, both, 4)
    assert sorted(b for p in parts for b in p) == list(range(64))
    where = {b: k for k, p in enumerate(parts) for b in p}
    assert sum(where[8 + i] == where[40 + i] for i in range(8)) >= 7


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 301), (301, 300), (5, 5)]
    links += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(60)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = components(501, links)
    assert got == {a: r for a, r in enumerate(root) if a != r}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprints_of_odd_texts():
    texts = ["", " \t", "One", "a b", "A b C d", "é É", "x" * 10000, "a\x0bb\x0cc\rd"]
    got = sh.fingerprints_of(pa.array(texts, pa.string())).tolist()
    assert got == [fingerprint(t) for t in texts]
