"""Block-list scan operators.

The scan is map-only: every text is matched where it lies, against a block
list that is collected once (size-checked) and shipped with the task.  No
text is shuffled, joined or exploded.  Three physical forms give the same
answer:

* ``native``    literal word array + ``instr`` higher-order functions; all
                JVM, best for short lists (cost grows with words x text);
* ``probe``     hashed substrings in numpy over Arrow batches
                (:mod:`sifter.functions.wordprobe`), for long lists; cost grows
                with the text and with the beginnings of words in it;
* ``automaton`` a library's Aho-Corasick automaton per Python worker, when asked
                for: faster where texts are full of words.

``strategy="auto"`` picks ``native`` up to ``NATIVE_MAX_WORDS`` words.

A list over the broadcast bound (:func:`probed_hits`) is probed too, with a
filter of bounded size, and what may be words is joined with the word table,
once for each block of texts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sifter.functions import automaton as ac
from sifter.functions import wordprobe
from sifter.functions.text import all_matches, ascii_fold, contains_any, first_match, fold_for_scan
from sifter.session import write_and_read
from sifter.sources import tables
from sifter.sources.tables import collect_block_list

NATIVE_MAX_WORDS = 48


def as_word_list(words: DataFrame | Sequence[str], max_words: int | None = None,
                 max_bytes: int | None = None) -> list[str]:
    """Folded, non-empty, distinct words from a DataFrame or a list; over the broadcast bound it raises."""
    if isinstance(words, DataFrame):
        return collect_block_list(words, max_words, max_bytes)
    from sifter.constants import LOWER_ASCII, UPPER_ASCII
    table = str.maketrans(UPPER_ASCII, LOWER_ASCII)
    return tables.check_block_list(sorted({w.translate(table) for w in words if w}), max_words, max_bytes)


def word_list_or_table(spark, words: DataFrame | Sequence[str], max_words: int | None = None,
                       max_bytes: int | None = None) -> list[str] | DataFrame:
    """The list to ship, or the word table when it is over the bound (then texts are probed with a filter of it)."""
    try:
        return as_word_list(words, max_words, max_bytes)
    except tables.BlockListTooLarge:
        return words if isinstance(words, DataFrame) else tables.block_list_from_values(spark, words)


def pick_strategy(words: Sequence[str], strategy: str = "auto") -> str:
    if strategy not in ("auto", "native", "probe", "automaton"):
        raise ValueError(f"unknown scan strategy {strategy!r}")
    if strategy == "auto":
        return "native" if len(words) <= NATIVE_MAX_WORDS else "probe"
    return strategy


def prepare_scan_text(text: Column, words: Sequence[str], strategy: str = "auto") -> Column:
    """The text as the chosen scan wants it: folded on the JVM for ``native``, raw for the automaton.

    Project this into its own column before calling a ``*_col(..., prepared=True)``
    function: the native forms reference the text once per word inside
    lambda functions, where Catalyst does not share sub-expressions.
    """
    if words and pick_strategy(words, strategy) == "native":
        return fold_for_scan(text, words)
    return text


def first_match_col(text: Column, words: Sequence[str], strategy: str = "auto", prepared: bool = False) -> Column:
    """S3 as a column over raw text (NULL text -> NULL, not scanned)."""
    if not words:
        return F.lit(None).cast("string")
    if pick_strategy(words, strategy) == "native":
        return first_match(text if prepared else ascii_fold(text), words)
    return _shipped_match(text, words, strategy, every=False)


def _shipped_match(text: Column, words: Sequence[str], strategy: str, every: bool) -> Column:
    if pick_strategy(words, strategy) == "automaton":
        return ac.automaton_all_matches(text, words) if every else ac.automaton_first_match(text, words)
    return wordprobe.match_words(text, *ac.share_words(words), every)


def all_matches_col(text: Column, words: Sequence[str], strategy: str = "auto", prepared: bool = False) -> Column:
    """S4 as a column over raw text."""
    if not words:
        return F.array().cast("array<string>")
    if pick_strategy(words, strategy) == "native":
        return all_matches(text if prepared else ascii_fold(text), words)
    return _shipped_match(text, words, strategy, every=True)


def contains_any_col(text: Column, words: Sequence[str], strategy: str = "auto", prepared: bool = False) -> Column:
    """S2 as a column over raw text."""
    if not words:
        return F.lit(False)
    if pick_strategy(words, strategy) == "native":
        return contains_any(text if prepared else ascii_fold(text), words)
    return _shipped_match(text, words, strategy, every=False).isNotNull()


def scan_texts(df: DataFrame, text_col: str, words, strategy: str = "auto", keep: Sequence[str] = (),
               max_words: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """S2+S3 over a table: keep columns, ``hit`` and ``matched_word`` (NULL when none), for a list of any size."""
    wl = word_list_or_table(df.sparkSession, words, max_words, max_bytes)
    if isinstance(wl, DataFrame):
        found = probed_hits(df.select(*keep, F.col(text_col).alias("_text")), "_text", wl, every=False)
    else:
        staged = df.select(*keep, prepare_scan_text(F.col(text_col), wl, strategy).alias("_text"))
        found = staged.select(*keep, first_match_col(F.col("_text"), wl, strategy, prepared=True).alias("matched_word"))
    return found.select(*keep, F.col("matched_word").isNotNull().alias("hit"), "matched_word")


def word_hits(df: DataFrame, id_col: str, text_col: str, words, strategy: str = "auto",
              max_words: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """J3/S4 in relational form: one row (id, word, rank) per word present in the text, for a list of any size.

    The substring "join" is evaluated per text against the shipped list
    and then exploded, so there is no nested-loop join of texts x words.
    """
    wl = word_list_or_table(df.sparkSession, words, max_words, max_bytes)
    if isinstance(wl, DataFrame):
        staged = probed_hits(df.select(id_col, F.col(text_col).alias("_text")), "_text", wl, every=True)
        arr = F.col("matched_words")
    else:
        staged = df.select(F.col(id_col), prepare_scan_text(F.col(text_col), wl, strategy).alias("_text"))
        arr = all_matches_col(F.col("_text"), wl, strategy, prepared=True)
    return staged.select(F.col(id_col), F.posexplode(arr).alias("rank", "word")) \
        .select(id_col, "word", (F.col("rank") + 1).alias("rank"))


def block_list_fits(words: DataFrame, max_words: int | None = None,
                    max_bytes: int | None = None) -> tuple[bool, int, int]:
    """(fits one broadcast, words, bytes) of a folded block list."""
    max_words = max_words or tables.MAX_BLOCK_WORDS
    max_bytes = max_bytes or tables.MAX_BLOCK_BYTES
    st = words.agg(F.count(F.lit(1)).alias("n"),
                   F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).first()
    return st["n"] <= max_words and st["b"] <= max_bytes, st["n"], st["b"]


def list_probe(words: DataFrame) -> wordprobe.Probe:
    """What the texts are probed with: built in tasks over the word table, at most 20 MB for any list."""
    by_length = words.groupBy(F.char_length("word").alias("n")).agg(F.count(F.lit(1)).alias("words")).collect()  # a row per length
    size = wordprobe.filter_words(sum(r["words"] for r in by_length))
    rows = words.select("word").mapInArrow(lambda b: wordprobe.list_bits(b, size), "kind int, w long, bits long") \
        .groupBy("kind", "w").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most a row per entry of either
    arrays = [np.zeros(n, np.int64) for n in (size, wordprobe.GATE_WORDS)]
    for kind, array in enumerate(arrays):
        some = rows[rows["kind"] == kind]
        array[some["w"].to_numpy()] = some["bits"].to_numpy()
    return wordprobe.Probe(*(x.view(np.uint64) for x in arrays), [r["n"] for r in by_length])


def probed_hits(df: DataFrame, text_col: str, words: DataFrame, every: bool) -> DataFrame:
    """``df`` without its text and with what a block list of any size finds in it, in one pass over the texts.

    ``every``: the rows with a word, and ``matched_words``, all its words in
    the order of reporting; else all rows, and ``matched_word``, the first one
    (NULL when none).  The pass finds candidates
    (:mod:`sifter.functions.wordprobe`) and writes the rows with them, a
    block of about a million characters at a time: a substring stands once in
    its block's list, and a row has numbers in that list.  The lists are joined to
    the word table by the substring itself, so a substring that very many
    texts have is a key's row once a block; what is a word goes back to the
    block's rows, which are shuffled once and as numbers.
    """
    spark = df.sparkSession
    listed = write_and_read(words.select("word", F.substring("word", 1, wordprobe.LONG).alias("probe"),
                                         F.char_length("word").alias("n")), "scan-words")
    shared = spark.sparkContext.broadcast(vars(list_probe(listed)))
    plain = df.select(*[c for c in df.columns if c != text_col], F.col(text_col).alias("_text"))
    kept = plain.drop("_text").schema.fields
    candidate = StructType().add("probe", StringType()).add("tail", StringType())
    schema = StructType([*kept, StructField("_block", LongType()), StructField("_code", ArrayType(IntegerType())),
                         StructField("_at", ArrayType(IntegerType())), StructField("_listed", ArrayType(candidate))])
    rows = write_and_read(plain.mapInArrow(wordprobe.candidate_finder(shared, schema.names), schema), "scan-rows")
    cand = rows.select(F.col("_block").alias("block"), F.posexplode("_listed").alias("code", "_c")) \
        .select("block", "code", "_c.probe", "_c.tail")
    real = cand.join(listed, "probe").where((F.col("n") <= wordprobe.LONG) | F.startswith("tail", "word")) \
        .select("block", "code", "word", "n")
    found = StructField("matched_words", ArrayType(StringType())) if every else StructField("matched_word", StringType())
    schema = StructType([*kept, found])
    texts = rows.drop("_listed")
    got = (texts.where(F.size("_code") > 0) if every else texts).groupBy("_block").cogroup(real.groupBy("block")) \
        .applyInArrow(wordprobe.word_resolver(schema, every), schema)
    return got.where(F.size("matched_words") > 0) if every else got


def first_match_table(df: DataFrame, key_col: str, text_col: str, words: DataFrame, *,
                      strategy: str = "auto", max_words: int | None = None,
                      max_bytes: int | None = None) -> DataFrame:
    """S3 for a block list of any size: (key, matched_word) for every row of ``df``."""
    return scan_texts(df, text_col, words, strategy, [key_col], max_words, max_bytes).select(key_col, "matched_word")


def block_list_size(words: DataFrame) -> DataFrame:
    """Number of non-empty folded words (input already folded and de-duplicated).

    Given a coverage table (word, posts), also the number of words present in any post.
    """
    aggs = [F.count(F.lit(1)).alias("block_list_size")]
    if "posts" in words.columns:
        aggs.append(F.count_if(F.col("posts") > 0).alias("words_present"))
    return words.agg(*aggs)


def match_counts(verdicts: DataFrame) -> DataFrame:
    """Posts per reported word (audit of ``matched_word``)."""
    return verdicts.where(F.col("matched_word") != "") \
        .groupBy("matched_word").agg(F.count(F.lit(1)).alias("posts"))
