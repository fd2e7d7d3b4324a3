"""A mergeable Bloom filter of ids, as a table.

The filter is blocked: an id has one 64-bit word, by its hash, and four bits in
it.  It is built by a hash aggregate (``bit_or`` per word, partial on every
task) and asked by an equi-join on the word, so neither needs Python, and rows
that ask move nowhere when the table is broadcast.  A "no" is certain; a "yes"
is wrong for a few in a hundred ids, so callers keep an exact check behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ID = 12
MAX_WORDS = 1 << 20  # a broadcast filter: at most 2^20 words, 12 bytes each


def words_for(ids: int, most: int = MAX_WORDS) -> int:
    """Words of a filter for so many ids, a power of two; beyond ``most`` it says "yes" more often."""
    need = max(1, -(-ids * BITS_PER_ID // 64))
    return min(most, 1 << (need - 1).bit_length())


def word_of(key: Column, words: Column | int) -> Column:
    """The number of a key's word."""
    words = F.lit(words) if isinstance(words, int) else words
    return F.pmod(F.xxhash64(key, F.lit("word")), words.cast("long")).cast("int")


def mask_of(key: Column) -> Column:
    """A key's bits in its word."""
    h = F.xxhash64(key, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(4):
        place = F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def build_filter(ids: DataFrame, id_col: str, words: int) -> DataFrame:
    """(w, bits) of the ids in ``id_col``: at most ``words`` rows."""
    return ids.select(word_of(F.col(id_col), words).alias("w"), mask_of(F.col(id_col)).alias("m")) \
        .groupBy("w").agg(F.bit_or("m").alias("bits"))


def may_contain(df: DataFrame, id_col: str, filter_: DataFrame, words: int) -> DataFrame:
    """The rows of ``df`` whose id may be in the filter, where they are: the filter is broadcast (``MAX_WORDS``)."""
    f = F.broadcast(filter_.select(F.col("w").alias("_w"), F.col("bits").alias("_bits")))
    asked = df.withColumn("_ask", word_of(F.col(id_col), words)).withColumn("_mask", mask_of(F.col(id_col)))
    hit = (F.col("_ask") == F.col("_w")) & (F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask"))
    return asked.join(f, hit).select(*df.columns)
