"""Block-list matcher: the studied service's automaton cases, for both physical forms."""

import random

import pytest
from pyspark.sql import functions as F

from sifter.functions.automaton import Matcher
from sifter.operators import scan

STRATEGIES = ["native", "automaton"]


def first(spark, words, texts, strategy):
    wl = scan.as_word_list(words)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    out = df.select("id", scan.first_match_col(F.col("text"), wl, strategy).alias("w")).orderBy("id").collect()
    return [r["w"] for r in out]


def all_of(spark, words, text, strategy):
    wl = scan.as_word_list(words)
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(scan.all_matches_col(F.col("text"), wl, strategy).alias("a")).first()["a"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_basic_substring(spark, strategy):
    got = first(spark, ["he", "she", "his", "hers"], ["ushers", "his story", "nothing here", "quiet"], strategy)
    assert [g is not None for g in got] == [True, True, True, False]
    # "ushers": "she" ends at 3, "he" ends at 3 too -> longest wins
    assert got[0] == "she"


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_overlapping_all_matches(spark, strategy):
    assert all_of(spark, ["abc", "bcd", "cde"], "abcde", strategy) == ["abc", "bcd", "cde"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_ascii_case_insensitive(spark, strategy):
    assert first(spark, ["badword"], ["This is a BadWord!"], strategy) == ["badword"]
    # words are folded too
    assert first(spark, ["BADWORD"], ["a badword"], strategy) == ["badword"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_cjk(spark, strategy):
    assert first(spark, ["暴力", "违禁品"], ["这里有暴力内容", "正常内容"], strategy) == ["暴力", None]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_suffix_through_failure_link(spark, strategy):
    assert first(spark, ["announce", "nce"], ["since then"], strategy) == ["nce"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_word_ignored(spark, strategy):
    assert scan.as_word_list(["", "spam"]) == ["spam"]
    assert first(spark, ["", "spam"], ["clean " * 100], strategy) == [None]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_only_ascii_is_folded(spark, strategy):
    # KELVIN SIGN and dotted capital I stay as they are (lower() would fold them)
    assert first(spark, ["k"], ["K"], strategy) == [None]
    assert first(spark, ["i"], ["İ"], strategy) == [None]
    assert first(spark, ["K"], ["xKy"], strategy) == ["K"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_end_position_then_longest(spark, strategy):
    # "worthless" and "less" end together -> longest; an earlier-ending word beats an earlier-starting one
    assert first(spark, ["less", "worthless"], ["so worthless"], strategy) == ["worthless"]
    assert first(spark, ["abcdef", "cd"], ["abcdef"], strategy) == ["cd"]


def test_strategies_agree_on_random_texts(spark):
    rng = random.Random(5)
    alphabet = "abcAB暴力 "
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4))) for _ in range(30)})
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    a = first(spark, words, texts, "native")
    b = first(spark, words, texts, "automaton")
    m = Matcher(words)
    c = [m.first(t) for t in texts]
    assert a == b == c


def test_automaton_without_its_library_raises(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    with pytest.raises(RuntimeError, match="pyahocorasick"):
        Matcher(["he"])


def test_python_list_is_checked_too():
    from sifter.sources.tables import BlockListTooLarge

    assert scan.as_word_list(["a", "b"], max_words=2) == ["a", "b"]
    with pytest.raises(BlockListTooLarge):
        scan.as_word_list(["a", "b", "c", "d"], max_words=2)


@pytest.mark.parametrize("bound", [None, 2])
def test_repeated_delivery_is_judged_on_its_own_text(spark, bound):
    """Two deliveries of a post with different texts: the first wins, whatever the size of the list."""
    from sifter.plans.moderation import moderate

    t = spark.createDataFrame(
        [(1, 7, "t", "clean", 0, 0, 0), (1, 7, "t", "casino", 0, 0, 1)],
        "post_id long, user_id long, title string, content_snapshot string, image_count int, ms long, offset long") \
        .selectExpr("post_id", "user_id", "title", "content_snapshot", "image_count",
                    "timestamp_millis(ms) AS submitted_at", "0 AS partition", "offset")
    users = spark.createDataFrame([(7, "u", "e", 0, 80)],
                                  "user_id long, username string, email string, violation_count int, reputation int")
    got = moderate(t, ["casino", "spam", "scam", "xx"], users, max_words=bound).collect()
    assert [(r.post_id, r.status) for r in got] == [(1, "approved")]


def test_long_list_gives_the_same_hits(spark):
    rng = random.Random(4)
    words = ["he", "she", "his", "hers", "less", "worthless", "nce", "announce"]
    texts = ["".join(rng.choice("hersiwotlnacu ") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "id long, text string")

    def run(bound):
        hits = scan.word_hits(df, "id", "text", words, max_words=bound).collect()
        firsts = scan.scan_texts(df, "text", words, keep=["id"], max_words=bound).collect()
        return sorted((r.id, r.word, r["rank"]) for r in hits), sorted((r.id, r.hit, r.matched_word or "") for r in firsts)

    assert run(None) == run(3)


def test_block_list_size_check(spark):
    from sifter.sources.tables import block_list_from_values, collect_block_list

    words = block_list_from_values(spark, ["Spam", "spam", "", "Scam"])
    assert collect_block_list(words) == ["scam", "spam"]
    with pytest.raises(ValueError):
        collect_block_list(words, max_words=1)


def test_oversize_block_list_gives_the_same_verdicts(spark, monkeypatch):
    """A list over the broadcast bound gives the same verdicts through the probe."""
    from conftest import SF_SMALL
    from sifter.plans import catalog
    from sifter.plans.moderation import moderate
    from sifter.sources import tables, testdata as TD

    expect = sorted(tuple(r) for r in catalog.q_moderate(spark, SF_SMALL).collect())
    monkeypatch.setattr(tables, "MAX_BLOCK_WORDS", 3)
    words = catalog._words(spark)
    assert not scan.block_list_fits(words)[0]
    got = moderate(TD.tasks(spark, SF_SMALL), words, TD.users(spark, SF_SMALL))
    assert sorted(tuple(r) for r in got.collect()) == expect


def test_first_match_table_equals_single_pass(spark):
    from sifter.sources.tables import block_list_from_values

    rng = random.Random(21)
    words = ["he", "she", "his", "hers", "less", "worthless", "nce", "announce", "暴力", "K"]
    texts = ["".join(rng.choice("hersiwotlnacuK暴力 ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    wdf = block_list_from_values(spark, words)
    one = {r.id: r.matched_word for r in scan.first_match_table(df, "id", "text", wdf).collect()}
    many = {r.id: r.matched_word for r in scan.first_match_table(df, "id", "text", wdf, max_words=2).collect()}
    assert one == many and len(one) == 300


def test_lower_fast_path_equals_ascii_fold(spark):
    """Texts with Kelvin sign, dotted I, accented capitals and sigma: the fast fold finds the same words."""
    from sifter.functions.text import fold_for_scan, words_fold_with_lower

    rng = random.Random(8)
    alphabet = "abkiKIÉéΣσς暴力 Kİ"
    words = ["ki", "bk", "暴力", "ab", "a暴", "kk", "ib"]
    assert words_fold_with_lower(words) and not words_fold_with_lower(["é"])
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    wl = scan.as_word_list(words)
    fast = df.select("id", fold_for_scan(F.col("text"), wl).alias("t")) \
        .select("id", scan.first_match_col(F.col("t"), wl, "native", prepared=True).alias("w"))
    got = {r.id: r.w for r in fast.collect()}
    m = Matcher(words)
    assert got == {i: m.first(t) for i, t in enumerate(texts)}


def test_closed_form_equals_automaton_on_30000_cases():
    """The reported word is the earliest-ending one, ties to the longest: automaton = closed form."""
    rng = random.Random(30000)
    ties = 0
    for _ in range(30000):
        words = list({"".join(rng.choice("abcAB") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 6))})
        text = "".join(rng.choice("abcABd ") for _ in range(rng.randint(0, 25)))
        m = Matcher(words)
        folded = text.translate(str.maketrans("AB", "ab"))
        present = [(folded.find(w) + len(w), -len(w), w) for w in m.words if w in folded]
        expect = min(present)[2] if present else None
        if len(present) > 1 and sorted(present)[0][0] == sorted(present)[1][0]:
            ties += 1
        assert m.first(text) == expect
    assert ties > 300  # the tie rule was exercised


def test_flagship_same_with_both_scan_forms(spark):
    from conftest import SF_SMALL
    from sifter.plans import catalog
    from sifter.plans.moderation import moderate
    from sifter.sources import testdata as TD

    def run(strategy):
        v = moderate(TD.tasks(spark, SF_SMALL), catalog._words(spark), TD.users(spark, SF_SMALL), strategy=strategy)
        return sorted(tuple(r) for r in v.collect())

    assert run("native") == run("automaton")
