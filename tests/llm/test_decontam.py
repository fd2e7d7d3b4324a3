import hashlib
import random
import re

from sifter.llm.decontam import contamination, find_matches, remove_contaminated


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(source, items, window=10):
    places = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for a in range(len(w) - n + 1) if w else ():
            places.setdefault(tuple(w[a:a + n]), set()).add(str(item))
    out = []
    for k, text in source:
        w, hit, found = words(text), set(), set()
        for n in {len(p) for p in places}:
            for a in range(len(w) - n + 1):
                got = places.get(tuple(w[a:a + n]))
                if got:
                    hit |= set(range(a, a + n))
                    found |= got
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(k), len(w), len(hit), len(found), names, len(hit) > 0))
    return sorted(out)


def check(spark, df, source, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(find_matches(df, bench, **options)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == \
        brute(source, items, options.get("window", 10))


def test_whole_table_in_one_and_in_many_blocks(spark, mid):
    df, source = mid
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    check(spark, df, source, items)
    more = items + [(900, "the"), (901, "THE and"), (902, ""), (903, None), (None, "of the"), (items[0][0], "to be"),
                    (777, items[3][1]), (778, items[3][1])]
    check(spark, df, source, more, block_bytes=3000)


def test_random_words_and_repeats(spark):
    rng = random.Random(6)
    for _ in range(2):
        def some(n):
            return " ".join(rng.choice("aAbcé1") for _ in range(n))
        source = [(i % 25, some(rng.randint(0, 40))) for i in range(40)]
        items = [(i, some(rng.randint(0, 8))) for i in range(12)]
        check(spark, spark.createDataFrame(source, "doc_id long, text string"), source, items, window=4)


def test_edges(spark, edge_docs, no_docs):
    from .conftest import ROWS

    check(spark, edge_docs, ROWS, [(1, "word word"), (2, "漢字"), (3, "nothing like it")])
    check(spark, edge_docs, ROWS, [])
    bench = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert find_matches(no_docs, bench).count() == 0


def test_longest_matches_and_their_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y " + " ".join(f"w{i}" for i in range(5, 25)) + " z " + " ".join(f"w{i}" for i in range(12)) + " q"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = find_matches(df, spark.createDataFrame([(7, item)], "item_id long, text string")).first().spans
    assert sorted((s["item"], s["item_word"], s["word"], s["length"]) for s in spans) == [("7", 0, 23, 12), ("7", 5, 2, 20)]


def test_affected_documents_go_and_clean_ones_stay(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(1, "clean", 5), (2, "say " + item, 6), (None, "clean too", 7), (3, " ".join(item.split()[:9]), 8), (1, "clean", 9)]
    kept = remove_contaminated(spark.createDataFrame(rows, "doc_id long, text string, spans int"),
                               spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "spans"] and sorted(r.spans for r in kept.collect()) == [5, 7, 8, 9]


def test_rows_are_judged_by_their_own_text(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(None, item, 1), (None, "clean", 2), (5, "a " + item, 3), (5, "clean", 4), (6, "clean", 5), (7, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    bench = spark.createDataFrame([(1, item), (2, "x y z " * 5), (3, "p q r " * 5)], "item_id long, text string")
    for options in ({}, {"block_bytes": 10}):
        kept = remove_contaminated(df, bench, **options)
        assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.row for r in kept.collect()) == [2, 4, 5, 6]
