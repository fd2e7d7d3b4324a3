import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from sifter.llm import prefix_trie as pt


def turns_of(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[conv].append((turn is not None, turn or 0, key, (role or "", text or "")))
    return {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}


def brute(rows):
    own = turns_of(rows)
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(first, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not kids[node]
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if rebuilt[c] == node)
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS key", "2 AS p", "3 AS depth", "4 AS `end`").repartition(3)
    got = [tuple(r) for r in pt.prefix_trie(df, **options).collect()]
    assert sorted(got, key=repr) == brute(rows)
    return got


def test_random_conversations(spark):
    rng = random.Random(3)
    for words, most in (("ab", 7), ("abcde", 4)):
        rows = [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", rng.choice(words))
                for c in range(-120, 260) if rng.random() < 0.8 for t in range(rng.randint(1, most))]
        got = check(spark, rows)
        assert max(r[1] for r in got) >= 4


def test_long_and_nested_conversations(spark):
    """Conversations that are beginnings of each other, cut inside long edges, in one batch and in several."""
    rows = [(7 * 100 + i, t, "u", f"turn {t}" if t < 40 - i or i % 3 else f"other {i}") for i in range(30) for t in range(10 + 3 * i)]
    check(spark, rows)
    check(spark, rows, batch_ends=(16,))
    check(spark, rows, batch_ends=(2, 5, 9, 12, 16))


def test_edges(spark):
    rows = [(1, None, None, None), (1, None, "user", ""), (1, 2, "user", "é漢🙂"), (1, 2, "user", "é漢🙂"), (1, 2, "a", "b"),
            (None, 0, "user", "nobody"), (100, 0, "us", "er:x"), (100, 1, "use", "r:x"), (101, 5, "", "long " * 5000),
            (102, 0, "user", "x"), (205, 1, "user", "no first relative"), (-5, 0, "user", "x"), (0, 3, "user", "x"), (0, 4, "user", "x")]
    check(spark, rows)
    check(spark, [(None, 1, "a", "b")])
    check(spark, [(5, 0, "a", "b")])
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pt.prefix_trie(empty).count() == 0


def test_hot_conversations_and_first_turns(spark):
    rows = [(100 * c, t, "u", "same" if c % 3 else f"mine {c}") for c in range(600) for t in range(3)]
    rows += [(100 * c + 7, t, "u", "same" if t < 6 else f"own {c}") for c in range(300) for t in range(8)]
    check(spark, rows)


def test_two_fattest(spark):
    def plain(a, b):
        return max(range(a + 1, b + 1), key=lambda x: x & -x)

    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int").select("a", "b", pt.two_fattest(F.col("a"), F.col("b")).alias("f"))
    assert all(r.f == plain(r.a, r.b) for r in df.collect())


def test_fat_binary_search_finds_the_exit_node(spark):
    """Against walking down the trie, for strings that are in it, leave it inside an edge, or leave it at a node."""
    rng = random.Random(9)

    def strings(n, seed):
        rng.seed(seed)
        rows = [(i, [bytes([rng.randint(0, 1)] * 16) if t % 3 == 0 else b"x" * 16 for t in range(rng.randint(0, 20))]) for i in range(n)]
        turns = spark.createDataFrame([(i, [(k, 1) for k in ks]) for i, ks in rows], "conv_id long, turns array<struct<k:binary,n:long>>")
        return pt.prefix_keys(turns).groupBy("end").agg(F.any_value("p").alias("p"), F.any_value("c").alias("c"))

    nodes = pt.build_trie(strings(60, 1))
    known = [(bytes(r.key), r.pd, r.ed, [bytes(x) for x in r.p]) for r in nodes.collect()]
    prefixes = {k for n in known for k in n[3]}
    extents = {n[0]: n for n in known}
    for r in pt.locate(nodes, strings(80, 2), 20).collect():
        p = [bytes(x) for x in r.p]
        lcp = max((d + 1 for d, k in enumerate(p) if k in prefixes), default=0)
        node = max((d + 1 for d, k in enumerate(p) if k in extents), default=0)
        assert (r.lcp, r.l) == (lcp, node)
        assert (r.xkey is not None) == (lcp > node)
        if r.xkey is not None:
            assert extents[bytes(r.xkey)][1] == node and extents[bytes(r.xkey)][3][lcp - 1] == p[lcp - 1]


def test_digests_of_a_key_spread_over_tasks(spark):
    rows = [(b"a" * 16, i) for i in range(-50, 20000)] + [(bytes([i]) * 16, i) for i in range(200)]
    df = spark.createDataFrame(rows, "end binary, conv_id long").repartition(7)
    ids = defaultdict(list)
    for k, i in rows:
        ids[k].append(i)
    assert {bytes(r.key): r.ends_sha256 for r in pt.ends_digest(df).collect()} == {
        k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in ids.items()}
