"""Packing along a space-filling curve.

Each document's subword ids are hashed into a signed vector, the vector is
projected to three dimensions, and the point's place on a Hilbert curve is the
document's key.  Documents are range-sorted by that key and laid end to end,
so neighbours on the curve share sequences; every sequence but the last is
full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize, only, running_sum
from sifter.llm.tokens import groups, vocab_path, with_end, word_table

END_ID = 2
SEQUENCE = 4096
BUCKETS = 256  # of the hashed document vector
DIMS = 3
BITS = 16  # of each dimension on the curve
SEED = 20_240_607

ENCODED_SCHEMA = "doc_id long, n_tokens long, curve_key long, ids binary"
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long")


def projection(dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """A fixed Gaussian projection of the hashed vectors."""
    return np.random.default_rng(seed).standard_normal((BUCKETS, dims))


def hashed_vectors(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One unit vector per document: signed hashed counts of its ids, square-rooted against long-document weight."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = (mixed >> np.uint64(56)).astype(np.int64)
    sign = np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    row = np.repeat(np.arange(len(counts)), counts)
    v = np.bincount(row * BUCKETS + bucket, weights=sign, minlength=len(counts) * BUCKETS).reshape(-1, BUCKETS)
    v = np.sign(v) * np.sqrt(np.abs(v))
    return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)


def grid(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Points (about unit normal in each dimension) to whole grid coordinates, by the logistic curve."""
    u = 1.0 / (1.0 + np.exp(-1.702 * points))
    return np.minimum((u * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert_key(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (rows of ``coords``) on the Hilbert curve through the grid.

    From the highest bit down, each dimension whose bit is set mirrors the
    lower bits of the first dimension, else it swaps them with its own; a Gray
    decoding of the mirrored bits then gives the order along the curve.
    """
    x = coords.astype(np.int64).copy()
    n = x.shape[1]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(n):
            mirror = (x[:, d] >> b & 1).astype(bool)
            swap = np.where(mirror, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(mirror, low, swap)
            x[:, d] ^= swap
    for d in range(1, n):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, n - 1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | (x[:, d] >> b & 1)
    return key


def encode_documents(docs: DataFrame, vocab: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens (with the end id), curve_key and ids (little-endian 16-bit, or 32-bit for a larger vocabulary)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(vocab or vocab_path())
        matrix = projection()
        for batch in batches:
            for first, texts in groups(batch.column(1)):
                ids, counts = table.encode(texts)
                keys = hilbert_key(grid(hashed_vectors(ids, counts) @ matrix))
                ids, counts = with_end(ids, counts, end_id)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(counts), pa.array(keys),
                     table.as_binary(ids, counts, end_id)],
                    ["doc_id", "n_tokens", "curve_key", "ids"])

    return only(docs, "doc_id", "text").mapInArrow(encode, ENCODED_SCHEMA)


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, vocab: str | None = None, end_id: int = END_ID,
                   with_ids: bool = True) -> DataFrame:
    """Pack all ``docs`` (doc_id, text) into sequences of ``sequence`` ids; one row per piece.

    Columns: doc_id, start (the document's ids before the piece), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers),
    doc_tokens (with the end id), sequence_id, offset (in the sequence) and,
    unless ``with_ids`` is off, ids (array<int>).

    NULL and empty texts are the end id alone.  Documents with the same key
    (copies) are ordered by a hash of doc_id and then by row, so a large group
    of copies is dealt over many tasks.  A document longer than a sequence
    has a piece in each sequence it fills.  Only the last sequence is short.
    An empty table has no pieces.

    The ids are written once; the order and the running sum use slim rows.
    """
    encoded = materialize(
        encode_documents(docs, vocab, end_id).withColumn("row", F.monotonically_increasing_id()), "packed-ids")
    places = running_sum(
        encoded.select("row", "n_tokens", "curve_key", F.xxhash64("doc_id").alias("_salt")),
        ["curve_key", "_salt", "row"], "n_tokens", "at", "packed-order").select("row", "at")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u4" if word_table(vocab or vocab_path()).wide(end_id) else "<u2"
        for batch in batches:
            doc_ids, sizes, raws, places = batch.columns
            at, n = places.to_numpy(), sizes.to_numpy()
            first, last = at // sequence, (at + n - 1) // sequence
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            seq = np.repeat(first - (np.cumsum(pieces) - pieces), pieces) + np.arange(int(pieces.sum()))
            begin = np.maximum(seq * sequence, at[doc])
            start, length = begin - at[doc], np.minimum((seq + 1) * sequence, at[doc] + n[doc]) - begin
            whole = [np.frombuffer(r.as_buffer(), kind).astype("<u4") for r in raws]
            cuts = [whole[d][s:s + k] for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            columns = [doc_ids.take(pa.array(doc)), pa.array(start), pa.array(length),
                       pa.array([zlib.crc32(c.tobytes()) for c in cuts], pa.int64()), pa.array(n[doc]), pa.array(seq),
                       pa.array(begin - seq * sequence)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(cuts, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return (encoded.select("doc_id", "n_tokens", "ids", "row").join(places, "row")
            .select("doc_id", "n_tokens", "ids", "at")
            .mapInArrow(cut, PIECE_SCHEMA + (", ids array<int>" if with_ids else "")))


ship_by_value(__name__)
