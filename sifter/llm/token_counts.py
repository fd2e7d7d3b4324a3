"""Unigram token counts: distinct pre-tokens in a trie, one forward score per shared prefix.

The best segmentation of a word under a unigram model is a forward recurrence
over its prefixes, and the score of a prefix does not depend on what follows.
So the distinct pre-tokens go into a trie, each node's best score and token
count are computed once, from its ancestors, when the node is made, and a
pre-token's count is what its last node stores.

The pieces are those of a public SentencePiece file.  Its order is by rank, so
a piece's log-probability is Zipf's: ``-ln((rank + 1) * H)`` with ``H`` the
sum that makes the probabilities one, kept in whole micro-nats so that sums
are exact.  Characters that no piece covers fall back to one byte piece per
UTF-8 byte, at the score of the rank after the last one.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import only
from sifter.llm.tokens import groups, split_words, vocab_path, worker_state

PIECE_FILE = "piece_bpe_32k.model"
WORD_START = "▁"
MICRO = 1_000_000
MAX_NODES = 1_000_000  # of a worker's trie; it starts again beyond that
MAX_WORDS = 500_000


def zipf_scores(pieces: list[str]) -> tuple[dict[str, int], int]:
    """Micro-nat scores of pieces in rank order, and the score of a byte piece."""
    total = math.log(sum(1.0 / (r + 1) for r in range(len(pieces) + 1)))
    score = [-round(MICRO * (math.log(r + 1) + total)) for r in range(len(pieces) + 1)]
    return dict(zip(pieces, score)), score[-1]


def load_pieces(path: str | None = None) -> tuple[dict[str, int], int]:
    """Scores of the ordinary pieces of a SentencePiece file, in the file's rank order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or vocab_path(PIECE_FILE))
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    ids.sort(key=lambda i: (-model.get_score(i), i))
    return zipf_scores([model.id_to_piece(i) for i in ids])


class UnigramTrie:
    """Trie of pre-tokens; each node has the best score of its prefix and that segmentation's tokens.

    Among segmentations of equal score the one with fewer tokens counts.
    """

    def __init__(self, scores: dict[str, int], byte_score: int, max_nodes: int = MAX_NODES):
        self.scores, self.byte_score, self.max_nodes = scores, byte_score, max_nodes
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}  # by (node, character) in one number
        self.best, self.tokens = array("q", [0]), array("q", [0])

    def insert(self, word: str) -> tuple[int, int]:
        """(tokens, score) of ``word``; only prefixes that are new to the trie are scored."""
        if len(self.best) > self.max_nodes:
            self.clear()
        child, best, tokens, scores = self.child, self.best, self.tokens, self.scores
        path = [0]
        node = 0
        for end, ch in enumerate(word, start=1):
            edge = node << 21 | ord(ch)
            nxt = child.get(edge)
            if nxt is None:
                nxt = child[edge] = len(best)
                width = len(ch.encode("utf-8", "surrogatepass"))
                top, least = best[node] + width * self.byte_score, tokens[node] + width
                for start in range(max(0, end - self.longest), end):
                    s = scores.get(word[start:end])
                    if s is not None:
                        before = path[start]
                        s += best[before]
                        if s > top or s == top and tokens[before] < least:
                            top, least = s, tokens[before] + 1
                best.append(top)
                tokens.append(least)
            node = nxt
            path.append(node)
        return tokens[node], best[node]


class CountTable:
    """Tokens and scores by distinct word, from the trie."""

    def __init__(self, pieces: tuple[dict[str, int], int], max_words: int = MAX_WORDS):
        self.trie = UnigramTrie(*pieces)
        self.max_words = max_words
        self.known: dict[str, tuple[int, int]] = {"": (0, 0)}

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        got = list(map(known.get, words))
        if None in got:
            fresh = sorted(w for w, k in zip(words, got) if k is None)  # neighbours share prefixes
            if len(known) + len(fresh) > self.max_words:
                known = self.known = {"": (0, 0)}
                fresh = sorted(w for w in words if w)
            insert = self.trie.insert
            known.update((w, insert(WORD_START + w)) for w in fresh)
            got = [known[w] for w in words]
        pairs = np.array(got, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def count_tokens(docs: DataFrame, piece_file: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and log_prob (natural log) of every whole text.

    Words are what blanks, tabs and line ends separate; a word is the
    pre-token of its characters after a word-start mark.  Blanks are part of
    that mark; each tab or line end counts as one byte piece.  NULL and empty
    texts have no words and no tokens.  One row per input row, in a single
    pass without a shuffle; a worker's trie and word table are bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_state(f"unigram:{piece_file}", lambda: CountTable(load_pieces(piece_file)))
        for batch in batches:
            for first, texts in groups(batch.column(1)):
                breaks = sum(pc.count_substring(texts, ch).to_numpy(zero_copy_only=False).astype(np.int64)
                             for ch in "\n\t\r")
                offsets, words = split_words(texts)
                coded = pc.dictionary_encode(words)
                names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                tokens, score = table.look_up(names)
                real = np.fromiter(map(bool, names), np.int64, len(names))
                which = coded.indices.to_numpy(zero_copy_only=False)

                def per_text(values: np.ndarray) -> np.ndarray:
                    edge = np.concatenate([[0], np.cumsum(values[which])])
                    return edge[offsets[1:] - offsets[0]] - edge[offsets[:-1] - offsets[0]]

                logs = (per_text(score) + breaks * table.trie.byte_score) / MICRO
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(per_text(real)),
                     pa.array(per_text(tokens) + breaks), pa.array(logs)],
                    ["doc_id", "n_words", "n_tokens", "log_prob"])

    texts = only(docs, "doc_id", "text")
    return texts.mapInArrow(count, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, "
                                   "n_words long, n_tokens long, log_prob double")


ship_by_value(__name__)
