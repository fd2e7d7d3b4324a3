"""Whole-text subword encoding inside tasks, with one encoding per distinct word.

The tokenizer (``word_bpe_49k.json`` of the public vocabulary files) never
joins text across white space, so a text's ids are its words' ids in order.
Each Python worker keeps the ids of the words it has met in a bounded table,
and asks the tokenizers library only about new words; a batch of texts is
then two array gathers.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sifter.functions.pyworker import ship_by_value

VOCAB_FILE = "word_bpe_49k.json"
MAX_WORDS = 1_000_000  # of a worker's table; it starts again beyond that
GROUP_BYTES = 6_000_000  # texts are encoded in groups of at most this size
JOIN_WORDS = 500  # new words in one call of the library


def vocab_path(name: str = VOCAB_FILE) -> str:
    """Where the public vocabulary files are on this machine (executors resolve their own)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_state(key: str, make: Callable[[], object]):
    """An object that lives as long as the Python worker (its code is shipped by value, so not in this module)."""
    holder = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


class WordTable:
    """Ids by distinct word, as one flat array with starts and lengths."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.max_words = max_words
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 12, np.int64)
        self.lens = np.zeros(1 << 12, np.int64)

    def _append(self, ids: list[list[int]]) -> None:
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        self._append_flat(np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens)

    def _append_flat(self, ids: np.ndarray, lens: np.ndarray) -> None:
        """The ids of the words numbered from len(index) on."""
        first, end = len(self.index), len(self.index) + len(lens)
        if len(self.starts) < end:
            self.starts, self.lens = (np.resize(x, 2 * end) for x in (self.starts, self.lens))
        if len(self.flat) < self.used + len(ids):
            self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
        self.lens[first:end] = lens
        self.starts[first:end] = self.used + np.cumsum(lens) - lens
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _library(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of new words.  Letter-only words are one pre-token each, so many of them go through one call,
        and its ids are cut after the pieces that end a word."""
        letters = [w for w in words if w.isalpha()]
        out: dict[str, list[int]] = {}
        for first in range(0, len(letters), JOIN_WORDS):
            some = letters[first:first + JOIN_WORDS]
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            cuts = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(cuts) == len(some):
                out.update(zip(some, (ids[i:j] for i, j in zip([0, *cuts], cuts))))
        rest = [w for w in words if w not in out]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            out[w] = e.ids
        return out

    def _encode_new(self, words: list[str]) -> None:
        new = self._library(words)
        self._append(list(new.values()))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the table's entries ``at``, one after the other, and how many each has."""
        lens = self.lens[at]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[at] - (ends - lens), lens) + np.arange(total)], lens

    def look_up(self, words: list[str]) -> np.ndarray:
        """The table's entries of distinct words; new ones are encoded first."""
        got = list(map(self.index.get, words))
        fresh = [w for w, k in zip(words, got) if k is None]
        if not fresh:
            return np.array(got, np.int64)
        if len(self.index) + len(fresh) > self.max_words and len(self.index) > 1:
            self.clear()
            fresh = [w for w in words if w]
        self._encode_new(fresh)  # distinct
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def entries(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct entries, which of them each word is, words of each text)."""
        lists, words = split_words(set_marks_apart(texts))
        coded = pc.dictionary_encode(words)
        at = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return at, coded.indices.to_numpy(zero_copy_only=False), np.diff(lists)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and how many each has."""
        distinct, which, counts = self.entries(texts)
        ids, lens = self.gather(distinct[which])
        edge = np.concatenate([[0], np.cumsum(lens)])
        upto = np.cumsum(counts)
        return ids, edge[upto] - edge[upto - counts]

    def wide(self, end_id: int) -> bool:
        """Whether ids need four bytes; two do where all fit."""
        return max(self.size, end_id + 1) > 1 << 16

    def as_binary(self, ids: np.ndarray, counts: np.ndarray, end_id: int) -> pa.Array:
        """The ids of each text as little-endian bytes."""
        raw = ids.astype("<u4" if self.wide(end_id) else "<u2")
        offsets = np.concatenate([[0], np.cumsum(counts)]) * raw.itemsize
        return pa.Array.from_buffers(pa.binary(), len(counts), [
            None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw.tobytes())])


def set_marks_apart(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and a blank before each '.' or ',' that ends a word after one of a-z.

    Both leave the ids as they are (the tokenizer lower-cases, and such a mark
    is a pre-token of its own), but far fewer distinct words remain.
    """
    texts = translate(texts, byte_table(b"\n\t\r"))
    _, offsets, data = texts.buffers()
    if data is None or not data.size:
        return texts
    offsets, data = np.frombuffer(offsets, np.int32, len(texts) + 1), np.frombuffer(data, np.uint8)
    ends_word = np.append(data[1:] == 0x20, True)
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends_word[last] = True
    after = np.append(False, (data[:-1] >= 0x61) & (data[:-1] <= 0x7A))
    after[offsets[:-1][offsets[1:] > offsets[:-1]]] = False
    marks = np.flatnonzero(((data == 0x2E) | (data == 0x2C)) & ends_word & after)
    moved = offsets + np.searchsorted(marks, offsets)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(moved.astype(np.int32)),
                                       pa.py_buffer(np.insert(data, marks, np.uint8(0x20)).tobytes()))


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets per text and the words: split at each blank, tab and line end (empty words between two of them)."""
    for ch in "\n\t\r":
        texts = pc.replace_substring(texts, ch, " ")
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], lists.flatten()


def byte_table(separators: bytes, lower: bool = True) -> bytes:
    """A byte translation: separators to blanks and, if asked for, A-Z to a-z.  ASCII only, so UTF-8 stays valid."""
    table = bytearray(range(256))
    if lower:
        table[0x41:0x5B] = range(0x61, 0x7B)
    for b in separators:
        table[b] = 0x20
    return bytes(table)


def translate(texts: pa.Array, table: bytes) -> pa.Array:
    """All texts through a byte translation, in one call over their buffer."""
    _, offsets, data = texts.buffers()
    if data is None:
        return texts
    offsets = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)
    first, last = int(offsets[0]), int(offsets[-1])
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - first).astype(np.int32)),
                                       pa.py_buffer(data[first:last].to_pybytes().translate(table)))


def real_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, pa.Array]:
    """(words of each text, all words) after the translation; no word is empty.  NULL must have become empty."""
    lists = pc.split_pattern(translate(texts, table), " ")
    offsets, words = lists.offsets.to_numpy(), lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return np.diff(upto[offsets - offsets[0]]), words.filter(real)


def word_table(path: str | None = None, max_words: int = MAX_WORDS) -> WordTable:
    """The worker's table for the vocabulary at ``path``."""
    path = path or vocab_path()
    return worker_state(f"words:{path}:{max_words}", lambda: WordTable(path, max_words))


def groups(texts: pa.Array, group_bytes: int = GROUP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of bounded bytes (one longer text is a slice of its own), NULL as empty."""
    texts = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        base = sizes[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(sizes, base + group_bytes, side="right")))
        yield first, texts.slice(first, end - first)
        first = end


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and the counts with it."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


ship_by_value(__name__)
