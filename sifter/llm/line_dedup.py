"""Repeated line runs by a suffix array over line ids.

The corpus is one sequence of lines in (doc_id, row) order, with a gap after
each document.  Distributed prefix doubling ranks the line windows: level 0
ranks single lines, and level k + 1 ranks windows of 2**(k+1) lines by the
pair (rank of the first half, rank of the second half).  Ranks are in
lexicographic order of the line ids; only windows that occur twice are kept,
so each level is smaller than the last.

A run counts when it has at least ``min_words`` words.  The suffixes that
share the shortest prefix of that many words are an LCP interval; its least
position is the copy that stays.  A maximal repeated run is the union of such
shortest windows, taken forward from its lines and backward from its end, so
the doubling need not go deeper than ``min_words`` lines.

Only built-in functions; lines are read, hashed and ranked as slim rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.common import materialize, running_sum

MIN_WORDS = 50
LINE = "\n"


def split_lines(text: Column) -> Column:
    return F.split(text, LINE, -1)


def line_weight(line: Column) -> Column:
    """Words of a line (runs of other than ASCII white space), and 1 for a line without any."""
    return F.greatest(F.regexp_count(line, F.lit(r"[^ \t\r\f\x0B]+")), F.lit(1))


def line_table(rows: DataFrame) -> DataFrame:
    """(row, pos, p, a, b, weight): each line's place p in the corpus and a 128-bit id (a, b) of its text.

    Documents follow each other by doc_id (NULL first), then by row; one
    place after each document stays empty, so no window runs over its end.
    """
    text = F.col("text")
    sizes = rows.select("_row", "doc_id", F.coalesce(F.size(split_lines(text)) + 1, F.lit(1)).cast("long").alias("places"))
    starts = running_sum(sizes, ["doc_id", "_row"], "places", "start", "line-starts").select("_row", "start")
    lines = rows.filter(text.isNotNull()).select("_row", F.posexplode(split_lines(text)).alias("pos", "line")).select(
        "_row", "pos", F.xxhash64("line").alias("a"),
        F.shiftleft(F.hash("line").cast("long"), 32).bitwiseOR(F.crc32(F.col("line").cast("binary"))).alias("b"),
        line_weight(F.col("line")).cast("int").alias("weight"))
    return materialize(lines.join(starts, "_row").withColumn("p", F.col("start") + F.col("pos")).drop("start"), "lines")


def rank_repeated(windows: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """The rows of ``windows`` whose (first, second) occurs twice, with their rank r in that order.

    Pairs are counted in the tasks before they are shuffled; a rank is the
    count of repeated windows before it, summed over range partitions.
    """
    pairs = windows.groupBy(first, second).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranks = running_sum(pairs, [first, second], "n", "r", name).select(first, second, "r")
    return windows.join(ranks, [first, second])


def prefix_doubling(lines: DataFrame, depth: int) -> list[DataFrame]:
    """Per level k, (p, r) for each window of 2**k lines that occurs twice, while 2**k <= depth."""
    level = materialize(rank_repeated(lines, "a", "b", "ranks").select("p", "r", "_row", "weight"), "level")
    levels, k = [level], 0
    while 2 ** (k + 1) <= depth:
        head = levels[-1].select("p", F.col("r").alias("r1"))
        tail = levels[-1].select((F.col("p") - 2 ** k).alias("p"), F.col("r").alias("r2"))
        after = materialize(rank_repeated(head.join(tail, "p"), "r1", "r2", "ranks").select("p", "r"), "level")
        if after.isEmpty():
            break
        levels.append(after)
        k += 1
    return levels


def shortest_windows(level0: DataFrame, min_words: int) -> DataFrame:
    """(s, n): for each repeated line the shortest window of ``min_words`` words that starts at it, and that ends at it.

    A line weighs at least 1, so no window has more than ``min_words`` lines.
    A line that occurs once breaks a window: nothing that holds it is repeated.
    """
    near = Window.partitionBy("_row").orderBy("p")
    place = F.struct("p", "weight")

    def reach(places: Column, step: int) -> Column:
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
        got = F.aggregate(
            places, none,
            lambda acc, x: F.when((acc["words"] < min_words) & (x["p"] == F.col("p") + step * acc["n"]),
                                  F.struct((acc["words"] + x["weight"]).alias("words"), (acc["n"] + 1).alias("n")))
            .otherwise(acc))
        return F.when(got["words"] >= min_words, got["n"])

    both = level0.select(
        "p",
        F.collect_list(place).over(near.rangeBetween(0, min_words - 1)).alias("_ahead"),
        F.collect_list(place).over(near.rangeBetween(1 - min_words, 0)).alias("_back"),
    ).select("p", reach(F.col("_ahead"), 1).alias("ahead"), reach(F.reverse("_back"), -1).alias("back"))
    return (both.select(F.explode(F.array(
        F.struct(F.col("p").alias("s"), F.col("ahead").alias("n")),
        F.struct((F.col("p") - F.col("back") + 1).alias("s"), F.col("back").alias("n")))).alias("w"))
        .select("w.s", "w.n").filter("n IS NOT NULL").distinct())


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """(s, n) of the shortest windows that occurred before."""
    levels = prefix_doubling(lines, min_words)
    ranks = levels[0].select(F.lit(0).alias("k"), "p", "r")
    for k, level in enumerate(levels[1:], start=1):
        ranks = ranks.unionByName(level.select(F.lit(k).alias("k"), "p", "r"))
    windows = shortest_windows(levels[0], min_words)
    k = F.floor(F.log2("n") + F.lit(1e-9)).cast("int")
    windows = windows.select("s", "n", k.alias("k")).withColumn("t", F.col("s") + F.col("n") - F.expr("shiftleft(1, k)"))
    head = ranks.select("k", F.col("p").alias("s"), F.col("r").alias("r1"))
    tail = ranks.select("k", F.col("p").alias("t"), F.col("r").alias("r2"))
    named = materialize(windows.join(head, ["k", "s"]).join(tail, ["k", "t"]).select("s", "n", "r1", "r2"), "windows")
    first = materialize(named.groupBy("n", "r1", "r2").agg(F.min("s").alias("first"), F.count(F.lit(1)).alias("copies"))
                        .filter("copies > 1").drop("copies"), "first-windows")
    # both sides come from files, so a window with very many copies is a skewed join side that can be split
    return named.join(first, ["n", "r1", "r2"]).filter("s > first").select("s", "n")


def repeated_lines(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_row, pos, repeated) for every line of the rows that lose a line."""
    lines = line_table(rows)
    ends = later_copies(lines, min_words).groupBy(F.col("s").alias("p")).agg(F.max(F.col("s") + F.col("n")).alias("end"))
    upto = Window.partitionBy("_row").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (lines.select("_row", "pos", "p").join(ends, "p", "left")
            .withColumn("repeated", F.coalesce(F.max("end").over(upto) > F.col("p"), F.lit(False)))
            .select("_row", "pos", "repeated"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without the later copies of repeated line runs.

    A run is a row of lines with at least ``min_words`` words (a line without
    words counts as one) that occurs before, in this or an earlier document
    (by doc_id, NULL first; then by row).  Its lines go; all others stay, in
    order.  Columns are kept, with ``text`` edited and ``n_lines_dropped``
    (long) added; a document that is all repeated keeps its row with an empty
    text.  NULL stays NULL, empty stays empty, repeated rows are copies like
    any other, and an empty table stays empty.
    """
    # the rows get their number once; both uses read the same files
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "line-rows")
    marks = (repeated_lines(rows, min_words).groupBy("_row")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "repeated"))), lambda x: x["repeated"]).alias("_gone"),
                  F.sum(F.col("repeated").cast("long")).alias("n_lines_dropped"))
             .filter("n_lines_dropped > 0"))
    left = F.filter(split_lines(F.col("text")), lambda x, i: ~F.element_at("_gone", i + 1))
    return rows.join(marks, "_row", "left").select(
        *[F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, LINE)).alias("text")
          if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce("n_lines_dropped", F.lit(0)).alias("n_lines_dropped"))
