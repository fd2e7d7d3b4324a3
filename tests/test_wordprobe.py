"""Block lists over the broadcast bound: one pass over the texts, exact answers."""

import random

import pytest

from sifter.functions import wordprobe
from sifter.operators import scan
from sifter.sources.tables import block_list_from_values

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, words):
    words = sorted({w.translate(UPPER) for w in words if w})
    out = []
    for i, t in texts:
        t = (t or "").translate(UPPER)
        found = sorted((t.find(w) + len(w), -len(w), w) for w in words if w in t)
        out += [(i, w, r) for r, (_, _, w) in enumerate(found, 1)]
    return sorted(out)


def hits(spark, texts, words):
    """By the join with the word table; the list shipped whole gives the same."""
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    listed = block_list_from_values(spark, words)
    got, local = (sorted((r.id, r.word, r["rank"]) for r in scan.word_hits(df, "id", "text", listed, **o).collect())
                  for o in ({"max_words": 1}, {"strategy": "probe"}))
    assert got == local
    firsts = {r.id: r.matched_word for r in scan.scan_texts(df, "text", listed, "probe", keep=["id"]).collect()}
    assert firsts == {**{i: None for i, _ in texts}, **{i: w for i, w, rank in got if rank == 1}}
    return got


def random_words(rng, n, longest):
    return ["".join(rng.choice("abcAéK漢🙂 ") for _ in range(rng.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("longest,seed", [(3, 1), (9, 2), (150, 3)])
def test_random_texts_and_words(spark, longest, seed):
    rng = random.Random(seed)
    words = random_words(rng, 60, longest)
    texts = [(i, "".join(rng.choice([*"abcAKé漢🙂 ", rng.choice(words)]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    texts += [(1000, None), (1001, ""), (1002, "x" * 5000 + words[0])]
    assert hits(spark, texts, words) == brute(texts, words)


def test_words_longer_than_the_probe_with_the_same_beginning(spark):
    start = "long beginning " * 5  # 75 characters
    words = [start + x for x in ("", "a", "ab", "b", "a" * 100)] + [start[:64], start[:63], start[:65]]
    texts = [(0, start + "c and " + start + "ab"), (1, start[:64]), (2, start[:70]), (3, "x" + start + "a" * 99), (4, (start + "b") * 3)]
    assert hits(spark, texts, words) == brute(texts, words)


def test_a_filter_that_says_yes_too_often_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(wordprobe, "MAX_WORDS", 1)
    rng = random.Random(5)
    words = random_words(rng, 300, 6)
    texts = [(i, "".join(rng.choice("abcd ") for _ in range(60))) for i in range(40)]
    assert hits(spark, texts, words) == brute(texts, words)


def test_the_filter_says_no_to_most_other_substrings(spark):
    rng = random.Random(6)
    words = [f"w{i:05d}x" for i in range(4000)]
    probe = scan.list_probe(block_list_from_values(spark, words))
    assert len(probe.bits) * 64 <= 4 * 16 * len(words)
    text = "".join(f"w{rng.randrange(10**5):05d}x " for _ in range(5000))
    found = [w for _, w, _ in probe.candidates([text])[0]]
    real = {w for w in words if w in text}
    assert real <= set(found) and len(found) < 1.1 * len(real) + 20


def test_the_texts_are_read_once_whatever_the_list(spark):
    seen = spark.sparkContext.accumulator(0)
    texts = spark.createDataFrame([(i, f"some text {i} with word{i % 50}") for i in range(300)], "id long, text string")

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    words = block_list_from_values(spark, [f"word{i}" for i in range(200)])
    once = texts.mapInPandas(count, texts.schema)
    assert scan.word_hits(once, "id", "text", words, max_words=2).count() >= 300
    assert seen.value == 300
    got = scan.scan_texts(texts.mapInPandas(count, texts.schema), "text", words, keep=["id"], max_words=2)
    assert got.where("hit").count() == 300 and seen.value == 600


def test_a_re_run_over_a_judged_history_scans_next_to_no_text(spark, monkeypatch):
    from conftest import SF_SMALL
    from sifter.plans import catalog, moderation
    from sifter.sources import testdata as TD

    scanned = []
    real = moderation.content_rules
    monkeypatch.setattr(moderation, "content_rules", lambda t, *a, **k: scanned.append(t.count()) or real(t, *a, **k))
    tasks, words, users = TD.tasks(spark, SF_SMALL), catalog._words(spark), TD.users(spark, SF_SMALL)
    whole = moderation.moderate(tasks, words, users)
    verdicts = {r.post_id: tuple(r) for r in whole.collect()}
    stored = spark.createDataFrame([v for k, v in verdicts.items() if k % 20], whole.schema)
    again = {r.post_id for r in moderation.moderate(tasks, words, users, prior_results=stored).collect()}
    assert again == {k for k in verdicts if k % 20 == 0}
    assert scanned[0] == len(verdicts) and len(again) <= scanned[1] <= len(again) + 0.1 * len(verdicts)
    plan = moderation.skip_judged(tasks, stored)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_a_candidate_is_listed_once_for_its_block_and_texts_have_numbers(spark):
    """What many texts hold is neither written nor shuffled once a text."""
    words = ["alpha", "beta", "gamma"]
    probe = scan.list_probe(block_list_from_values(spark, words))
    codes, places, listed = wordprobe.block_candidates(probe, ["Beta alpha beta", None, "alpha", "none"] * 200)
    subs = [c["probe"] for c in listed[0].as_py()]
    assert set(words[:2]) <= set(subs) and len(subs) == len(set(subs)) and listed.null_count == 799
    assert [[subs[i] for i in x if subs[i] in words] for x in codes.to_pylist()[:4]] == [["beta", "alpha"], [], ["alpha"], []]
    assert places.null_count == 800  # only words over LONG need them

    texts = spark.createDataFrame([(i, "beta alpha gamma " * 3) for i in range(50)], "id long, text string")
    got = scan.word_hits(texts, "id", "text", block_list_from_values(spark, words), max_words=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.word, r["rank"]) for r in got.where("id = 7").collect()) == [("alpha", 2), ("beta", 1), ("gamma", 3)]
    # numbers to the blocks, and the blocks' words: no shuffle of a row per text and word, nor of the texts' ids beside it
    assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_kept_columns_of_any_type_stay_as_they_are(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.range(20).selectExpr("id", "IF(id % 3 = 0, NULL, concat('has word', id % 5)) AS text", "timestamp_millis(id * 1000) AS t",
                                        "timestamp_millis(id)::timestamp_ntz AS z", "array(struct(id, 'x' AS s)) AS a", "map('k', id) AS m",
                                        "id::decimal(9,2) AS d", "date_add(date'2024-01-01', id::int) AS day")
        words = block_list_from_values(spark, [f"word{i}" for i in range(4)])
        keep = [c for c in df.columns if c != "text"]
        got, local = (sorted(map(str, scan.scan_texts(df, "text", words, "probe", keep, max_words=n).collect())) for n in (2, None))
        assert got == local and sum("hit=True" in x for x in got) == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
