"""Scalar text functions, all JVM-side (codegen-friendly built-ins).

The block-list matcher semantics (S1-S4):

* folding lowers ASCII ``A-Z`` only; every other code point is kept
  (``lower()`` would also fold U+212A KELVIN SIGN and expand U+0130);
* a word matches anywhere (no word boundary);
* the *reported* word is the one whose earliest occurrence **ends first**;
  among words ending at the same position the longest wins.

The array forms below evaluate a literal word array per row: no join, no
shuffle, no Python.  They cost ``O(words x text)`` per row, so they are the
choice for short lists; :mod:`sifter.functions.automaton` covers long ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sifter.constants import LOWER_ASCII, UPPER_ASCII

# Unicode white space as Go's strings.TrimSpace sees it (\s, NEL, separators).
_EDGE_SPACE = r"^[\s\u0085\p{Z}]+|[\s\u0085\p{Z}]+$"


def ascii_fold(col: Column | str) -> Column:
    """Lower-case ASCII letters only."""
    return F.translate(_c(col), UPPER_ASCII, LOWER_ASCII)


# --- fixed values: the only code points whose lower case is ASCII or longer than one
# character (U+0130 -> "i" + U+0307, U+212A KELVIN SIGN -> "k"); checked over all of Unicode.
LOWER_NOT_ASCII_FOLD = "\u0130\u212a"


def words_fold_with_lower(words: Sequence[str]) -> bool:
    """True when ``lower()`` finds the same words at the same places as the ASCII fold.

    Holds when every non-ASCII character of the words is uncased: ``lower()``
    then differs from the ASCII fold only on text characters no word can
    match, except the two in ``LOWER_NOT_ASCII_FOLD``, which texts are checked for.
    """
    return all(ord(ch) < 128 or (ch.lower() == ch and ch.upper() == ch) for w in words for ch in w)


def fold_for_scan(col: Column | str, words: Sequence[str]) -> Column:
    """The ASCII fold of ``col`` as the scan needs it, through ``lower()`` where that is exact.

    ``lower()`` has a byte-level fast path; ``translate()`` looks up every
    character, several times slower on long texts.
    """
    c = _c(col)
    if not words_fold_with_lower(words) or _turkic_jvm_locale():
        return ascii_fold(c)
    odd = F.instr(c, LOWER_NOT_ASCII_FOLD[0]) + F.instr(c, LOWER_NOT_ASCII_FOLD[1])
    return F.when(odd > 0, ascii_fold(c)).otherwise(F.lower(c))


def _turkic_jvm_locale() -> bool:
    """Spark's ``lower()`` uses the JVM default locale, where Turkic ones fold ``I`` to dotless i."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    try:
        lang = spark.sparkContext._jvm.java.util.Locale.getDefault().getLanguage()
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. Spark Connect): stay exact
        return True
    return lang in ("tr", "az")


def unicode_trim(col: Column | str) -> Column:
    """Trim Unicode white space at both ends (``trim()`` only strips U+0020)."""
    return F.regexp_replace(_c(col), _EDGE_SPACE, "")


def code_points(col: Column | str) -> Column:
    """Length in code points (Go ``utf8.RuneCountInString``)."""
    return F.char_length(_c(col))


def words_array(words: Sequence[str]) -> Column:
    """Literal ``array<string>`` of already-folded words."""
    if not words:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(w) for w in words])


def _hit_structs(text: Column, words: Sequence[str]) -> Column:
    """(end, -len, word) for every word present in ``text``; text is already folded."""
    hits = F.filter(words_array(words), lambda w: F.instr(text, w) > 0)
    return F.transform(
        hits,
        lambda w: F.struct(
            (F.instr(text, w) + F.char_length(w) - 1).alias("end"),
            (-F.char_length(w)).alias("neg_len"),
            w.alias("word"),
        ),
    )


def contains_any(folded_text: Column | str, words: Sequence[str]) -> Column:
    """True when any word occurs in the (folded) text."""
    t = _c(folded_text)
    return F.exists(words_array(words), lambda w: F.instr(t, w) > 0)


def first_match(folded_text: Column | str, words: Sequence[str]) -> Column:
    """S3: the reported word or NULL: smallest end position, ties to the longest word."""
    t = _c(folded_text)
    return F.array_min(_hit_structs(t, words)).getField("word")


def all_matches(folded_text: Column | str, words: Sequence[str]) -> Column:
    """Every distinct word present, ordered by end position then longest first."""
    t = _c(folded_text)
    return F.transform(F.array_sort(_hit_structs(t, words)), lambda s: s.getField("word"))


def scan_text(title: Column | str, content: Column | str) -> Column:
    """Input of the word scan: ``title + ' ' + content`` (a word may span the seam)."""
    return F.concat(_c(title), F.lit(" "), _c(content))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
