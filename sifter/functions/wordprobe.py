"""Words of a list of any size in texts, by hashes of the text's substrings.

A :class:`Probe` knows, of a word list, which word lengths go with a beginning of
up to ``GRAM`` characters (the gate), and a Bloom filter of the words' hashes:
arrays of at most 20 MB, however long the list.  One pass over a batch of texts
asks the gate at every place, and computes prefix hashes, from which the hash of
any substring is one subtraction, to ask the filter about substrings of the
lengths that the gate names.  What is found
is a candidate: the substring itself, which the caller looks up in the word
table, so that a wrong "yes" of the filter falls out.

Words of more than ``LONG`` characters are probed by their first ``LONG``, and
the text that follows comes along.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sifter.functions.pyworker import ship_by_value

GRAM = 4
LONG = 64
BITS_PER_WORD = 16
MAX_WORDS = 1 << 21  # of 64 bits: 16 MB
GATE_BITS = 19  # 2^19 beginnings, each with a bit per word length: 4 MB
GATE_WORDS = 1 << GATE_BITS
GROUP_CHARS = 1_000_000  # texts probed at a time, about
BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number


def filter_words(words: int) -> int:
    """64-bit words of a filter for so many list words, a power of two."""
    need = max(1, words * BITS_PER_WORD // 64)
    return min(MAX_WORDS, 1 << (need - 1).bit_length())


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i < n, modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b)])) for b in (BASE, inverse))


def _gate_place(codes: np.ndarray, gram: int) -> np.ndarray:
    """The gate's entry for the ``gram`` characters from each place on."""
    n = max(0, len(codes) - gram + 1)
    h = np.full(n, gram * 0x27D4EB2F, np.uint32)
    for i in range(gram):
        h *= np.uint32(0x01000193)
        h += codes[i:i + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - GATE_BITS)


def _mix(h: np.ndarray, length: int) -> np.ndarray:
    h = h + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Text:
    """Texts one after the other as code points (A-Z folded), with prefix hashes."""

    def __init__(self, texts: Sequence[str]):
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.sizes)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").copy()
        codes[(codes >= 0x41) & (codes <= 0x5A)] += 0x20
        self.codes = codes
        power, self.inverse = _powers(1 << max(20, len(codes).bit_length()))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * power[:len(codes)])])
        self.left = np.repeat(self.ends, self.sizes) - np.arange(len(codes))  # characters to the end of the text

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the substrings of ``length`` characters that begin at ``at``."""
        return _mix((self.sums[at + length] - self.sums[at]) * self.inverse[at], length)

    def same(self, at: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
        """Whether the substrings of ``length`` characters at ``at`` and ``other`` are the same."""
        span, out = np.arange(length), np.zeros(len(at), bool)
        for a in range(0, len(at), 1 << 16):
            b = a + (1 << 16)
            out[a:b] = (self.codes[at[a:b, None] + span] == self.codes[other[a:b, None] + span]).all(axis=1)
        return out

    def first_of_each(self, number: np.ndarray, at: np.ndarray, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(at, number) without places of a substring that is in the same text before; equal hashes are compared."""
        if not len(at):
            return at, number
        order = np.lexsort((at, h, number))
        number, at, h = number[order], at[order], h[order]
        first = np.append(True, (number[1:] != number[:-1]) | (h[1:] != h[:-1]))
        leader = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        again = np.flatnonzero(~first)
        keep = first.copy()
        keep[again] = ~self.same(at[again], leader[again], length)
        return at[keep], number[keep]

    def string(self, a: int, b: int) -> str:
        return self.codes[a:b].tobytes().decode("utf-32-le", "surrogatepass")


def _place(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Each hash's word in a filter of ``words`` and its four bits there."""
    mask = np.zeros(len(h), np.uint64)
    for i in range(4):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(24)) % np.uint64(words)).astype(np.int64), mask


def word_bits(words: Sequence[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(0 for the filter or 1 for the gate, word, bits) of folded list words, one entry per touched word."""
    text = Text([w[:LONG] for w in words])
    at, sizes = text.ends - text.sizes, text.sizes
    gates = {gram: _gate_place(text.codes, gram) for gram in range(1, GRAM + 1)}
    out = []
    for length in np.unique(sizes).tolist():
        some = at[sizes == length]
        out.append((0, *_place(text.hashes(some, length), size)))
        out.append((1, gates[min(length, GRAM)][some].astype(np.int64), np.full(len(some), 1 << (length - 1), np.uint64)))
    kinds, places, masks = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in
                            ([np.full(len(o[1]), o[0]) for o in out], [o[1] for o in out], [o[2] for o in out]))
    if not len(kinds):
        return kinds, places, masks.astype(np.uint64)
    keys = kinds * (1 << 32) + places
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(keys[order]) != 0))
    return kinds[order][first], places[order][first], np.bitwise_or.reduceat(masks[order], first)


class Probe:
    """The filter, the gate and the word lengths of a list."""

    def __init__(self, bits: np.ndarray, gate: np.ndarray, lengths: Sequence[int]):
        """``lengths``: of all words, in characters."""
        self.bits, self.gate = bits, gate
        self.lengths = sorted({min(n, LONG) for n in lengths})
        self.longest = max(lengths, default=0)

    def places(self, text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, place, length) of the substrings that may be words, by text and in the order of reporting:
        by end, the longest first.

        A substring is given at its first place in a text; one of LONG characters at all, because what follows differs.
        """
        found = []
        for gram in sorted({min(n, GRAM) for n in self.lengths}):
            lengths = [n for n in self.lengths if min(n, GRAM) == gram]
            named = self.gate[_gate_place(text.codes, gram)] & np.uint64(sum(1 << (n - 1) for n in lengths))
            some = np.flatnonzero(named)
            named, left = named[some], text.left[some]
            for n in lengths:
                at = some[(named & np.uint64(1 << (n - 1)) != 0) & (left >= n)]
                h = text.hashes(at, n)
                place, mask = _place(h, len(self.bits))
                hit = self.bits[place] & mask == mask
                at, h = at[hit], h[hit]
                number = np.searchsorted(text.ends, at, side="right")
                if n < LONG or self.longest <= LONG:
                    at, number = text.first_of_each(number, at, h, n)
                found.append((number, at, np.full(len(at), n)))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        number, at, length = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-length, at + length, number))
        return number[order], at[order], length[order]

    def tail(self, text: Text, number: int, at: int, length: int) -> str | None:
        """What a longer word is compared with."""
        if length < LONG or self.longest <= LONG:
            return None
        return text.string(at, min(int(text.ends[number]), at + self.longest))

    def candidates(self, texts: Sequence[str]) -> list[list[tuple[int, str, str | None]]]:
        """Per text: (place, substring, what follows for the first LONG of longer words)."""
        out: list[list[tuple[int, str, str | None]]] = [[] for _ in texts]
        text = Text(texts)
        starts = (text.ends - text.sizes).tolist()
        for i, a, n in zip(*(x.tolist() for x in self.places(text))):
            out[i].append((a - starts[i], text.string(a, a + n), self.tail(text, i, a, n)))
        return out


class WordSet:
    """A list that is here whole: its probe, and the words themselves to check candidates with."""

    def __init__(self, words: Sequence[str]):
        """``words``: folded, not empty."""
        size = filter_words(len(words))
        bits, gate = np.zeros(size, np.uint64), np.zeros(GATE_WORDS, np.uint64)
        kinds, places, masks = word_bits(words, size)
        for kind, array in enumerate((bits, gate)):
            array[places[kinds == kind]] = masks[kinds == kind]
        self.probe = Probe(bits, gate, [len(w) for w in words])
        self.words = {w for w in words if len(w) <= LONG}
        self.longer: dict[str, list[str]] = {}
        for w in words:
            if len(w) > LONG:
                self.longer.setdefault(w[:LONG], []).append(w)

    def _words(self, sub: str, tail: str | None) -> list[str]:
        """The words that begin where ``sub`` was found."""
        words = [sub] if sub in self.words else []
        if tail is not None:
            words += [w for w in self.longer.get(sub, ()) if tail.startswith(w)]
        return words

    def hits(self, texts: Sequence[str], every: bool) -> list[list[str]]:
        """Per text the word that ends first (ties: the longest), or with ``every`` all words in that order."""
        out: list[list[str]] = []
        text = Text(texts)
        number, at, length = self.probe.places(text)
        cuts = np.searchsorted(number, np.arange(len(texts) + 1)).tolist()
        long = bool(self.longer)
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            mine: dict[str, tuple[int, int]] = {}
            for place, n in zip(at[a:b].tolist(), length[a:b].tolist()):
                for w in self._words(text.string(place, place + n), self.probe.tail(text, i, place, n)):
                    mine.setdefault(w, (place + len(w), -len(w)))
                if mine and not every and not long:
                    break
            words = sorted(mine, key=mine.__getitem__)
            out.append(words if every else words[:1])
        return out


def text_groups(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column in groups of about GROUP_CHARS characters (one longer text is a group of its own)."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        base = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, base + GROUP_CHARS, side="right")))
        yield texts.slice(first, end - first).to_pylist()
        first = end


LISTED = pa.list_(pa.struct([("probe", pa.string()), ("tail", pa.string())]))


def block_candidates(probe: Probe, texts: Sequence[str | None]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(numbers, places, candidates) for a block of texts, NULL ones without any.

    The block's different candidates are listed once, with its first text; each
    text has their numbers in that list, in the order of reporting.  Places are
    given only for a list with words of more than LONG characters, because
    others are reported in the order in which they were found.
    """
    text = Text([t or "" for t in texts])
    number, at, length = probe.places(text)
    leader = np.arange(len(at))  # the first entry with the same substring
    for n in np.unique(length).tolist():
        if n == LONG and probe.longest > LONG:
            continue  # what follows differs
        some = np.flatnonzero(length == n)
        _, first, back = np.unique(text.hashes(at[some], n), return_index=True, return_inverse=True)
        lead = some[first[back]]
        leader[some] = np.where(text.same(at[some], at[lead], n), lead, some)
    lead, code = np.unique(leader, return_inverse=True)
    listed = [{"probe": text.string(a, a + n), "tail": probe.tail(text, i, a, n)}
              for i, a, n in zip(*(x[lead].tolist() for x in (number, at, length)))]
    cuts = pa.array(np.searchsorted(number, np.arange(len(texts) + 1)).astype(np.int32))

    def per_text(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(cuts, pa.array(values.astype(np.int32)))

    codes = per_text(code)
    places = per_text(at - (text.ends - text.sizes)[number]) if probe.longest > LONG else pa.nulls(len(texts), codes.type)
    return codes, places, pa.array([listed] + [None] * (len(texts) - 1), LISTED)


def candidate_finder(shared, names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: the last column (texts) becomes a block number and the columns of :func:`block_candidates`."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe.__new__(Probe)
        vars(probe).update(shared.value)
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            first = 0
            for some in text_groups(batch.column(batch.num_columns - 1)):
                rows = batch.slice(first, len(some))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(np.full(len(some), block)),
                                                  *block_candidates(probe, some)], list(names))
                first, block = first + len(some), block + 1

    return find


def reported(rows: pa.Table, words: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text number, word number, words) of what the texts of a block hold, each word once a text, in the order of reporting.

    ``words`` has the list words (code, word, n) that the block's candidates are, or begin.
    """
    listed = rows.column("_code").combine_chunks()
    counts = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
    code = listed.flatten().to_numpy(zero_copy_only=False)
    number = np.repeat(np.arange(len(counts)), counts)
    known = words.column("code").to_numpy()
    order = np.argsort(known, kind="stable")
    first = np.searchsorted(known[order], code)
    times = np.searchsorted(known[order], code, side="right") - first
    entry = np.repeat(np.arange(len(code)), times)
    word = order[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(len(entry))]
    number = number[entry]
    places = rows.column("_at").combine_chunks()
    if places.null_count < len(places):
        n = words.column("n").to_numpy()[word]
        order = np.lexsort((-n, places.flatten().to_numpy(zero_copy_only=False)[entry] + n, number))
        number, word = number[order], word[order]
    coded = pc.dictionary_encode(words.column("word").combine_chunks())
    word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[word]
    once = np.sort(np.unique(number * max(1, len(coded.dictionary)) + word, return_index=True)[1])
    return number[once], word[once], coded.dictionary


def word_resolver(schema: StructType, every: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For ``cogroup``: a block's rows with their words (``every``) or their first word, NULL when none, as last column."""
    def resolve(rows: pa.Table, words: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        number, word, dictionary = reported(rows, words)
        cuts = np.searchsorted(number, np.arange(rows.num_rows + 1))
        if every:
            found = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), dictionary.take(pa.array(word)))
        else:
            none = cuts[1:] == cuts[:-1]
            found = dictionary.take(pa.array(np.append(word, 0)[cuts[:-1]], mask=none))
        out = rows.select(schema.names[:-1]).append_column(schema.names[-1], found)
        return out.cast(to_arrow_schema(schema))

    return resolve


def match_column(words: WordSet, texts: pa.Array, every: bool) -> pa.Array:
    """Per text the word that ends first (ties: the longest), or with ``every`` all words in that order; NULL stays NULL."""
    out: list = []
    for some in text_groups(texts):
        # texts without anything to scan cost nothing
        held = [i for i, t in enumerate(some) if t is not None]
        answers: list = [None] * len(some)
        for i, found in zip(held, words.hits([some[i] for i in held], every)):
            answers[i] = found if every else found[0] if found else None
        out += answers
    return pa.array(out, pa.list_(pa.string()) if every else pa.string())


_CACHE_ATTR = "_sifter_word_sets"  # on ``sys``: this module is shipped by value, its globals are per task


def _word_set(shared, key: str) -> WordSet:
    """The worker's word set for the list with content hash ``key`` (built on first use)."""
    cache = sys.__dict__.setdefault(_CACHE_ATTR, {})
    if key not in cache:
        if len(cache) >= 4:  # a few lists per worker at a time keeps memory bounded
            cache.clear()
        cache[key] = WordSet(shared.value if hasattr(shared, "value") else shared)
    return cache[key]


def match_words(text: Column, shared, key: str, every: bool) -> Column:
    """S3 (or S4, with ``every``) over raw text for a list that is shipped whole; NULL texts stay NULL unread."""
    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _word_set(shared, key)
        for batch in batches:
            yield match_column(words, batch, every)

    return F.arrow_udf(match, returnType="array<string>" if every else "string")(text)


def list_bits(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The bits of a table of words (one column), to be combined by ``bit_or`` per (kind, w)."""
    for batch in batches:
        kinds, places, masks = word_bits(batch.column(0).to_pylist(), size)
        yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), pa.array(places), pa.array(masks.view(np.int64))],
                                         ["kind", "w", "bits"])


ship_by_value(__name__)
