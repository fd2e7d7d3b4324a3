"""Multi-word scan for long block lists: one automaton per Python worker.

The word list travels once per executor as a broadcast variable (its size is
checked by :func:`sifter.sources.tables.collect_block_list`).  Texts arrive
as Arrow batches through an iterator pandas UDF, so the automaton is built
once per worker process and reused for every batch and task after it.  Rows
that an earlier rule already decided should be passed as NULL: they cross
the JVM/Python boundary as a null bit and are not scanned.

``pyahocorasick`` (C) does the scan and must be on every Python worker.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from sifter.constants import LOWER_ASCII, UPPER_ASCII
from sifter.functions.pyworker import ship_by_value

_FOLD = str.maketrans(UPPER_ASCII, LOWER_ASCII)
# One matcher per Python worker process, shared by every batch and task the
# worker runs.  Kept on ``sys`` because this module is shipped by value (so
# executors need no copy of the package) and its globals are per-unpickle.
_CACHE_ATTR = "_sifter_matcher_cache"


class Matcher:
    """Reports the word whose earliest occurrence ends first (ties: longest)."""

    def __init__(self, words: Sequence[str]):
        self.words = sorted({w.translate(_FOLD) for w in words if w})
        self._ac = None
        if self.words:
            try:
                import ahocorasick
            except ImportError as e:  # a loop over all words would cost words x text without a word said
                raise RuntimeError("long block lists need pyahocorasick on every Python worker "
                                   "(requirements.txt)") from e
            ac = ahocorasick.Automaton()
            for w in self.words:
                ac.add_word(w, (len(w), w))
            ac.make_automaton()
            self._ac = ac

    def first(self, text: str | None) -> str | None:
        if text is None or not self.words:
            return None
        t = text.translate(_FOLD)
        best_end, best = -1, None
        for end, (n, w) in self._ac.iter(t):
            if best is None:
                best_end, best = end, (n, w)
            elif end == best_end:
                if n > best[0]:
                    best = (n, w)
            else:
                break
        return None if best is None else best[1]

    def all(self, text: str | None) -> list[str] | None:
        if text is None:
            return None
        t = text.translate(_FOLD)
        seen: dict[str, tuple[int, int]] = {}
        for end, (n, w) in self._ac.iter(t) if self.words else ():
            if w not in seen:
                seen[w] = (end, -n)
        return [w for w, _ in sorted(seen.items(), key=lambda kv: kv[1])]


def _matcher(bc, key: str) -> Matcher:
    """The worker's matcher for the list with content hash ``key`` (built on first use)."""
    cache = sys.__dict__.setdefault(_CACHE_ATTR, {})
    m = cache.get(key)
    if m is None:
        if len(cache) >= 4:  # a few lists per worker at a time keeps memory bounded
            cache.clear()
        m = cache[key] = Matcher(bc.value if hasattr(bc, "value") else bc)
    return m


_SHARED: dict[tuple[str, str], object] = {}  # one broadcast per list and application


def share_words(words: Sequence[str]):
    """(broadcast of the list, content hash of the list); a list met before reuses its broadcast.

    Without a SparkContext (Spark Connect) the size-checked list travels in
    the UDF's closure instead, once per task rather than once per executor.
    """
    ship_by_value(__name__)
    spark = SparkSession.getActiveSession()
    key = hashlib.sha1("\x00".join(words).encode("utf-8")).hexdigest()
    if not hasattr(spark, "_jsc"):  # Spark Connect has no SparkContext
        return tuple(words), key
    at = (spark.sparkContext.applicationId, key)
    if at not in _SHARED:
        while len(_SHARED) >= 8:
            _SHARED.pop(next(iter(_SHARED)))  # its blocks go when no plan holds it
        _SHARED[at] = spark.sparkContext.broadcast(tuple(words))
    return _SHARED[at], key


def automaton_first_match(text: Column, words: Sequence[str]) -> Column:
    """S3 as an Arrow-batched UDF; ``text`` is raw (folding happens in the worker)."""
    bc, key = share_words(words)

    @F.pandas_udf("string")
    def first_match_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = _matcher(bc, key)
        for s in batches:
            yield pd.Series([m.first(x) for x in s], dtype=object)

    return first_match_udf(text)


def automaton_all_matches(text: Column, words: Sequence[str]) -> Column:
    """S4 as an Arrow-batched UDF."""
    bc, key = share_words(words)

    @F.pandas_udf("array<string>")
    def all_matches_udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = _matcher(bc, key)
        for s in batches:
            yield pd.Series([m.all(x) for x in s], dtype=object)

    return all_matches_udf(text)
