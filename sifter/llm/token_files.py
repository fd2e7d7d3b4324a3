"""Token-ID files: static range asymmetric numeral system (rANS) blocks under one shared frequency table.

Layout.  A token set is a folder with two Parquet tables:

* ``table``: one row per id that occurs, with its slot count; the counts sum
  to 2**SLOT_BITS.  All blocks share it.
* ``blocks``: one row per block of consecutive documents in ascending
  (doc_id, text) order: part, block, part_start (ids of the same part before
  it), n_docs, n_ids, crc32 and payload.

A block's payload (little endian) is: doc_id of each document as int64, a
byte for each telling whether it is NULL, its id count as uint32, the count of
lanes as uint32, the final state of each lane as uint64 (the checkpoint from
which the lane is decoded), the count of 32-bit words as uint32, and the words.  Id k of the
block belongs to lane ``k mod lanes``; lanes are interleaved and advance
together, so one numpy step codes one id of every lane.  Blocks need nothing
of each other: any of them is decoded on its own, after its CRC-32 is checked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import drop_table, materialize, only, part_offsets, scratch_path, shuffle_width
from sifter.llm.tokens import groups, vocab_path, with_end, word_table, worker_state

END_ID = 1
SLOT_BITS = 20  # slots of the frequency table; more than ids in any vocabulary used here
LOW = np.uint64(1 << 31)  # a state lies in [2**31, 2**63)
BLOCK_IDS = 1 << 19
MAX_LANES = 4096
IDS_PER_LANE = 64

BLOCK_SCHEMA = ("part int, block long, part_start long, n_docs int, n_ids long, crc32 long, payload binary")
DOC_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"


# --- the frequency table -----------------------------------------------------

def slot_counts(ids: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Slots per id: in proportion to the counts, at least one each, 2**SLOT_BITS in all."""
    total = 1 << SLOT_BITS
    if len(ids) == 0:
        return np.zeros(0, np.int64)
    if len(ids) > total:
        raise ValueError("more ids than slots")
    share = times.astype(np.float64) / times.sum() * (total - len(ids))
    slots = np.floor(share).astype(np.int64) + 1
    left = total - int(slots.sum())
    order = np.lexsort((ids, -(share - np.floor(share))))  # largest remainders first
    slots[order[:left]] += 1
    return slots


class Coder:
    """Encoder and decoder for one frequency table."""

    def __init__(self, ids: np.ndarray, slots: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.slots = ids[order].astype(np.uint32), slots[order].astype(np.uint64)
        self.first = np.cumsum(self.slots) - self.slots
        self.at = np.zeros(int(self.ids[-1]) + 1 if len(ids) else 1, np.uint32)
        self.at[self.ids] = np.arange(len(ids), dtype=np.uint32)
        self.of_slot = np.repeat(np.arange(len(ids), dtype=np.uint32), slots[order])

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lane states, words); ids are coded from the last row of lanes to the first."""
        lanes = int(np.clip(len(ids) // IDS_PER_LANE, 1, MAX_LANES))
        state = np.full(lanes, LOW, np.uint64)
        at = self.at[ids]
        freq, first = self.slots[at], self.first[at]
        shift, bits, word = np.uint64(63 - SLOT_BITS), np.uint64(SLOT_BITS), np.uint64(32)
        out = []
        for row in range(-(-len(ids) // lanes) - 1, -1, -1):
            f, s = freq[row * lanes:(row + 1) * lanes], first[row * lanes:(row + 1) * lanes]
            x = state[:len(f)]
            full = np.flatnonzero(x >= (f << shift))
            if len(full):
                out.append(x[full].astype(np.uint32)[::-1])  # low 32 bits
                x[full] >>= word
            q = x // f
            x[:] = (q << bits) + (x - q * f) + s
        words = np.concatenate(out)[::-1] if out else np.zeros(0, np.uint32)
        return state, words

    def decode(self, n: int, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The n ids; states and words as ``encode`` gave them."""
        state, lanes, used = state.copy(), len(state), 0
        mask, bits, word = np.uint64((1 << SLOT_BITS) - 1), np.uint64(SLOT_BITS), np.uint64(32)
        out = np.zeros(n, np.uint32)
        for row in range(-(-n // lanes)):
            part = out[row * lanes:(row + 1) * lanes]
            x = state[:len(part)]
            slot = x & mask
            at = self.of_slot[slot]
            part[:] = at
            x[:] = self.slots[at] * (x >> bits) + slot - self.first[at]
            low = np.flatnonzero(x < LOW)
            if len(low):
                x[low] = (x[low] << word) | words[used:used + len(low)]
                used += len(low)
        return self.ids[out]


# --- blocks -------------------------------------------------------------------

def pack_block(coder: Coder, doc_ids: np.ndarray, no_id: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    state, words = coder.encode(ids)
    return b"".join([doc_ids.astype("<i8").tobytes(), no_id.astype("u1").tobytes(), counts.astype("<u4").tobytes(),
                     len(state).to_bytes(4, "little"), state.astype("<u8").tobytes(),
                     len(words).to_bytes(4, "little"), words.astype("<u4").tobytes()])


def unpack_block(coder: Coder, payload: bytes, crc: int, n_docs: int, n_ids: int):
    """(doc_ids, is NULL, counts, ids) of a block; a damaged block raises."""
    if zlib.crc32(payload) != crc:
        raise ValueError("token block: checksum does not match")
    at = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(payload, kind, n, at)
        at += x.nbytes
        return x

    doc_ids, no_id, counts = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    state = take("<u8", int(take("<u4", 1)[0]))
    words = take("<u4", int(take("<u4", 1)[0]))
    return doc_ids, no_id.astype(bool), counts, coder.decode(n_ids, state.astype(np.uint64), words)


def _coder(key: str, table) -> Coder:
    """The worker's coder for the broadcast table."""
    return worker_state(f"coder:{key}", lambda: Coder(*table.value))


def write_token_files(docs: DataFrame, path: str, vocab: str | None = None, end_id: int = END_ID,
                      block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) into the token set ``path``.

    Texts are taken in ascending doc_id order (NULL first, repeated doc_ids by
    a hash of the text).  NULL and empty texts have the end id only.  An empty
    table writes an empty set.

    Each text is encoded once.  The tasks write the ids and their own counts of
    each id; the counts make the table, then the ids are range-dealt and coded
    in blocks.  The table has one row per vocabulary id, so it is small enough
    to broadcast at any input size.  A document is never cut, so a block may
    exceed ``block_ids`` by one document.
    """
    spark = docs.sparkSession
    encoded = materialize(_encode(only(docs, "doc_id", "text"), vocab, end_id), "token-ids")

    def times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                seen = np.frombuffer(raw, "<i8")
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "times"])

    counted = (encoded.select("times").filter("times IS NOT NULL").mapInArrow(times, "id long, times long")
               .groupBy("id").agg(F.sum("times").alias("times")).toPandas())  # at most one row per vocabulary id
    ids, seen = counted["id"].to_numpy(np.int64), counted["times"].to_numpy(np.int64)
    order = np.argsort(ids)
    ids, slots = ids[order], slot_counts(ids[order], seen[order])
    spark.createDataFrame(pa.table({"id": pa.array(ids, pa.int32()), "slots": pa.array(slots, pa.int64())}),
                          "id int, slots long").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((ids, slots))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        part = TaskContext.get().partitionId()
        block = start = held = 0
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, start, held, waiting
            keys, nulls, counts, raws = zip(*waiting)
            ids = np.frombuffer(b"".join(raws), "<u4" if wide else "<u2")
            payload = pack_block(coder, np.array(keys, np.int64), np.array(nulls), np.array(counts, np.int64), ids)
            row = [part, block, start, len(keys), len(ids), zlib.crc32(payload), payload]
            block, start, held, waiting = block + 1, start + len(ids), 0, []
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              ["part", "block", "part_start", "n_docs", "n_ids", "crc32", "payload"])

        wide = word_table(vocab or vocab_path()).wide(end_id)
        for batch in batches:
            for key, n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                waiting.append((key or 0, key is None, n, raw))
                held += n
                if held >= block_ids:
                    yield flush()
        if waiting:
            yield flush()

    (encoded.filter("times IS NULL").select("doc_id", "n_tokens", "ids", "salt")
     .repartitionByRange(shuffle_width(spark), "doc_id", "salt")
     .sortWithinPartitions("doc_id", "salt").drop("salt")
     .mapInArrow(code, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    drop_table(spark, encoded)


def _encode(texts: DataFrame, vocab: str | None, end_id: int) -> DataFrame:
    """doc_id, salt, n_tokens and ids of each text; each task adds a row that has only ``times``, its count of each id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(vocab or vocab_path())
        names = ["doc_id", "salt", "n_tokens", "ids", "times"]
        seen = np.zeros(max(table.size, end_id + 1), np.int64)
        for batch in batches:
            for first, group in groups(batch.column(1)):
                ids, counts = with_end(*table.encode(group), end_id)
                seen += np.bincount(ids, minlength=len(seen))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(group)), batch.column(2).slice(first, len(group)), pa.array(counts),
                     table.as_binary(ids, counts, end_id), pa.nulls(len(group), pa.binary())], names)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
             pa.array([seen.astype("<i8").tobytes()], pa.binary())], names)

    return (texts.withColumn("salt", F.xxhash64("text"))
            .mapInArrow(encode, "doc_id long, salt long, n_tokens long, ids binary, times binary"))


def _open(spark: SparkSession, path: str):
    table = spark.read.schema("id int, slots long").parquet(f"{path}/table").toPandas()  # one row per vocabulary id
    shared = spark.sparkContext.broadcast((table["id"].to_numpy(np.int64), table["slots"].to_numpy(np.int64)))
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks"), shared


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token set with their ids: doc_id, part, block, ids array<long>."""
    blocks, shared = _open(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for row in batch.to_pylist():
                keys, nulls, counts, ids = unpack_block(coder, row["payload"], row["crc32"], row["n_docs"], row["n_ids"])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=nulls), pa.array(np.full(len(keys), row["part"], np.int32)),
                     pa.array(np.full(len(keys), row["block"], np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))],
                    ["doc_id", "part", "block", "ids"])

    return blocks.mapInArrow(decode, "doc_id long, part int, block long, ids array<long>")


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """Decode all blocks and return, per document: doc_id, start (ids of all documents before it), n_tokens
    (with the end id) and ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""
    blocks, shared = _open(spark, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, shared)
        for batch in batches:
            for row in batch.to_pylist():
                keys, nulls, counts, ids = unpack_block(coder, row["payload"], row["crc32"], row["n_docs"], row["n_ids"])
                ends = np.cumsum(counts.astype(np.int64))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=nulls), pa.array(np.full(len(keys), row["part"], np.int32)),
                     pa.array(row["part_start"] + ends - counts), pa.array(counts.astype(np.int64)),
                     pa.array(crc, pa.int64())],
                    ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    # one row per part, which is a task of the writing stage
    offsets = F.broadcast(part_offsets(blocks.select("part", "n_ids"), "n_ids", part="part"))
    return (blocks.mapInArrow(decode, DOC_SCHEMA).join(offsets, "part")
            .select("doc_id", (F.col("_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_index(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write ``docs`` as a token set (under the shared folder unless ``path`` says where) and read it back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, vocab, end_id)
    return read_token_index(docs.sparkSession, path)


ship_by_value(__name__)
