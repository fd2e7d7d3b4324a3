"""Benchmark decontamination with suffix arrays of the training text.

The documents are taken in shards.  A shard's words become numbers, its
suffixes are sorted, and every test suffix (each word position of each
benchmark item) is found by binary search: the range of suffixes that share
its window of words gives all places of a verbatim match.  Matches on the same
diagonal are joined to the longest ones.

A suffix can only share a window whose words are all benchmark words, so only
such suffixes enter the array; that prunes nothing that could match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize, only
from sifter.llm.tokens import byte_table, groups, real_words

WINDOW = 10
BLOCK_BYTES = 16 * 1024 * 1024  # of benchmark text that is broadcast at a time
# Words are digits, letters a-z and all characters past ASCII; A-Z are lower-cased.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

MATCH_SCHEMA = ("doc_id long, n_words long, n_hit long, items array<string>, "
                "spans array<struct<item:string,item_word:long,word:long,length:long>>, hits array<long>")


class TestSuffixes:
    """The benchmark as word numbers: one row per distinct window, with the places it comes from.

    Items of equal words stand once, under their least id; ``same`` has all their ids.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.number: dict[str, int] = {}
        places: dict[tuple[int, ...], list[tuple[str, int]]] = {}
        counts, words = real_words(pa.array([text for _, text in items], pa.string()), byte_table(SEPARATORS))
        words, ends = words.to_pylist(), np.cumsum(counts).tolist()
        equal: dict[tuple[int, ...], set[str]] = {}
        for (item, _), end, n in zip(items, ends, counts.tolist()):
            row = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words[end - n:end])
            if row:
                equal.setdefault(row, set()).add(item)
        self.same: dict[str, set[str]] = {}
        for row, ids in equal.items():
            self.same.setdefault(min(ids), set()).update(ids)
            width = min(window, len(row))
            for at in range(len(row) - width + 1):
                places.setdefault(row[at:at + width], []).append((min(ids), at))
        self.by_width = {}
        for width in sorted({len(k) for k in places}):
            keys = sorted(k for k in places if len(k) == width)
            self.by_width[width] = (np.array(keys, np.int64).reshape(-1, width), [places[k] for k in keys])
        self.shortest = min(self.by_width, default=0)
        self.vocabulary = pa.array(list(self.number), pa.string())  # numbers from 1 in this order

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words of each text, all word numbers); a word that no item has is 0."""
        counts, words = real_words(texts, byte_table(SEPARATORS))
        coded = pc.dictionary_encode(words)
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.vocabulary), -1)
        return counts, known.to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy()] + 1


def suffix_order(words: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that start at ``at``, sorted by their first ``depth`` words, and those words."""
    rows = words[at[:, None] + np.arange(depth)]
    order = np.lexsort(rows.T[::-1])
    return at[order], rows[order]


def search(rows: np.ndarray, keys: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all ``keys`` at once among sorted ``rows`` (compared on the keys' width)."""
    width = keys.shape[1]
    lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), len(rows), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) // 2
        differ = rows[mid, :width] - keys[live]
        first = (differ != 0).argmax(axis=1)
        sign = differ[np.arange(len(live)), first]
        right = sign <= 0 if upper else sign < 0
        lo[live[right]] = mid[right] + 1
        hi[live[~right]] = mid[~right]


def match_shard(tests: TestSuffixes, texts: pa.Array, window: int):
    """Per text: words, hit words, items, longest matches (item, item word, word, length), hit positions."""
    sizes, numbers = tests.numbers(texts)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    # one gap after each text, so that a shard's texts do not run into each other
    words = np.zeros(int(sizes.sum()) + len(sizes) + window, np.int64)
    words[np.arange(len(numbers)) + np.repeat(np.arange(len(sizes)), sizes)] = numbers
    sizes = sizes.tolist()
    hits = np.zeros(len(words) + 1, np.int64)
    found: dict[int, list[tuple[str, int, int, int]]] = {}
    if tests.shortest:
        unknown = np.concatenate([[0], np.cumsum(words == 0)])
        able = np.flatnonzero(unknown[tests.shortest:] == unknown[:-tests.shortest])
        able = able[able + window <= len(words)]
        at, sorted_rows = suffix_order(words, able, window)
        for width, (keys, places) in tests.by_width.items():
            low, high = search(sorted_rows, keys, False), search(sorted_rows, keys, True)
            for k in np.flatnonzero(low < high).tolist():
                here = at[low[k]:high[k]]
                np.add.at(hits, here, 1)
                np.add.at(hits, here + width, -1)
                docs = np.searchsorted(ends, here, side="right")
                for place, doc in zip(here.tolist(), docs.tolist()):
                    for item, word in places[k]:
                        found.setdefault(doc, []).append((item, word, place - int(starts[doc]), width))
    covered = np.cumsum(hits[:-1]) > 0
    for doc, (start, size) in enumerate(zip(starts.tolist(), sizes)):
        if doc not in found:
            yield size, 0, [], [], []
            continue
        where = np.flatnonzero(covered[start:start + size])
        yield size, len(where), sorted(set().union(*(tests.same[f] for f in {f[0] for f in found[doc]}))), longest(found[doc]), where.tolist()


def longest(found: list[tuple[str, int, int, int]]) -> list[dict]:
    """Windows on the same diagonal of the same item that follow each other are one match."""
    out: list[dict] = []
    last = None
    for item, word, place, width in sorted(found, key=lambda f: (f[0], f[2] - f[1], f[2])):
        if last == (item, place - word, place - 1):
            out[-1]["length"] += 1
        else:
            out.append({"item": item, "item_word": word, "word": place, "length": width})
        last = (item, place - word, place)
    return out


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The whole benchmark in blocks of bounded text, read one after the other."""
    block, size = [], 0
    for row in only(benchmark, "item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        block.append((str(row[0]), row[1]))
        size += len(row[1].encode("utf-8", "surrogatepass"))
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block or not size:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Verbatim matches of ``benchmark`` (item_id, text) in every whole text of ``docs`` (doc_id, text).

    Columns: doc_id, n_words, n_hit (words inside any occurrence of a window of
    ``window`` consecutive item words; a shorter item is one window), items
    (ids with occurring windows, sorted as strings), spans (longest matches:
    item, item_word and word where they start, length).  One row per input
    row.  NULL and empty texts and items have no words; a NULL item_id is the
    item 'None'; items with the same id count as one.

    Each block of the benchmark is broadcast (at most ``block_bytes`` of text
    and one item) and meets all documents in one pass without a shuffle; only a
    benchmark of several blocks needs its passes joined by document row.
    """
    spark = docs.sparkSession
    texts = only(docs, "doc_id", "text")
    passes = []
    for block in benchmark_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(block)

        def match(batches: Iterator[pa.RecordBatch], shared=shared, with_row=False) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(shared.value, window)
            for batch in batches:
                for first, group in groups(batch.column(1)):
                    cols = list(zip(*match_shard(tests, group, window)))
                    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()),
                             pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int64()),
                                                 ("word", pa.int64()), ("length", pa.int64())])), pa.list_(pa.int64())]
                    columns = [batch.column(0).slice(first, len(group)), *(pa.array(c, k) for c, k in zip(cols, kinds))]
                    if with_row:
                        columns.append(batch.column(2).slice(first, len(group)))
                    yield pa.RecordBatch.from_arrays(
                        columns, ["doc_id", "n_words", "n_hit", "items", "spans", "hits"] + (["row"] if with_row else []))

        passes.append(match)
    if len(passes) == 1:
        return texts.mapInArrow(passes[0], MATCH_SCHEMA).drop("hits")
    texts = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    every = None
    for match in passes:
        one = texts.mapInArrow(lambda b, m=match: m(b, with_row=True), MATCH_SCHEMA + ", row long")
        every = one if every is None else every.unionByName(one)
    return (every.groupBy("row")
            .agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                 F.array_distinct(F.flatten(F.collect_list("hits"))).alias("_hits"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                 F.flatten(F.collect_list("spans")).alias("spans"))
            .select("doc_id", "n_words", F.size("_hits").cast("long").alias("n_hit"), "items", "spans"))


def contamination(matches: DataFrame) -> DataFrame:
    """The digest of ``find_matches``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return matches.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    Each row is judged by its own text, whatever its doc_id, where it is read: no text is shuffled.  A benchmark of
    several blocks is a pass over what the one before kept.
    """
    at = docs.columns.index("text")
    kept = None
    for block in benchmark_blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = TestSuffixes(shared.value, window)
            for batch in batches:
                for first, group in groups(batch.column(at)):
                    clean = [m[1] == 0 for m in match_shard(tests, group, window)]
                    yield batch.slice(first, len(group)).filter(pa.array(clean, pa.bool_()))

        kept = (docs if kept is None else materialize(kept, "decontam-kept")).mapInArrow(keep, docs.schema)
    return kept


ship_by_value(__name__)
