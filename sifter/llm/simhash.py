"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprints of 64 bits are linked at a few differing bits.  The bits are
dealt into partitions, correlated bits together; partition i gets a threshold
t_i >= -1 with ``sum(t_i + 1) = distance + 1``.  Two fingerprints within the
distance then differ by at most t_i bits in some partition i with t_i >= 0, so
probing each partition for values within its threshold finds every link.  The
thresholds are chosen by dynamic programming on the candidate pairs that the
partition's value counts (of all distinct fingerprints) foretell.

Every candidate is checked on the whole fingerprint.  A bucket emits links of
a spanning forest of its members, not its pairs.  A bucket that is too large
for one task is split by a second exact match on a quarter of the other bits,
and what is still too large is linked through hubs (see ``_hub_links``), whose
work grows with the members and not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize, only, shuffle_width
from sifter.llm.components import connected_components
from sifter.llm.tokens import byte_table, groups, real_words

SHINGLE = 3
DISTANCE = 3
SEED = 42
PARTS = 4
BUCKET_ROWS = 4096  # members of a bucket that one task takes
GROUP_BYTES = 2_000_000
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"


# --- fingerprints ---------------------------------------------------------------

def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text (no words: 0)."""
    counts, words = real_words(texts, byte_table(SEPARATORS))
    out = np.zeros(len(counts), np.uint64)
    if not len(words):
        return out
    # the words with one blank after each; a shingle is a slice without its last blank
    spaced = pc.binary_join_element_wise(words, "", " ")
    offsets = np.frombuffer(spaced.buffers()[1], np.int32, len(spaced) + 1, 4 * spaced.offset)
    data = spaced.buffers()[2].to_pybytes()
    last = np.cumsum(counts)
    n = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first = np.arange(int(n.sum())) + np.repeat((last - counts) - (np.cumsum(n) - n), n)
    to = np.minimum(first + shingle, np.repeat(last, n))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(data[a:b], SEED) for a, b in zip(offsets[first].tolist(), (offsets[to] - 1).tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    some = np.flatnonzero(n)
    ones = np.add.reduceat(bits, (np.cumsum(n) - n)[some], axis=0, dtype=np.int32)
    out[some] = np.packbits(ones * 2 > n[some, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every whole text, and _row if ``docs`` has it."""
    keys = ["doc_id", *(c for c in docs.columns if c == "_row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in groups(batch.column(1), GROUP_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fingerprints_of(texts, shingle).view(np.int64))]
                    + [c.slice(first, len(texts)) for c in (batch.column(0), *batch.columns[2:])], ["fp", *keys])

    return only(docs, keys[0], "text", *keys[1:]).mapInArrow(run, "fp long, " + ", ".join(f"{k} long" for k in keys))


# --- partitions and thresholds -----------------------------------------------------

def _bits(fps: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, bit 0 (the lowest) first."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_products(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Count of fingerprints and, for each two bits, how often both are set (64 x 64, summed in the tasks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            b = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total, n = total + b.T @ b, n + len(b)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(64 * 64 + 1)), pa.array(np.append(total.ravel(), n).astype(np.int64))], ["k", "s"])

    rows = fps.select("fp").mapInArrow(run, "k long, s long").groupBy("k").agg(F.sum("s").alias("s")).toPandas()  # 4097 rows
    flat = np.zeros(64 * 64 + 1)
    flat[rows["k"]] = rows["s"]
    return int(flat[-1]), flat[:-1].reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of (nearly) equal width; each takes the bits most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < size:
            best = max(left, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        out.append(sorted(part))
    return out


def value_of(fp: Column, bits: list[int]) -> Column:
    """The bits of ``fp`` at the given places, as a number."""
    out = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1)), k))
    return out


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits among ``width``."""
    return [sum(1 << b for b in some) for k in range(radius + 1) for some in combinations(range(width), k)]


def pairs_within(counts: np.ndarray, radius: int) -> float:
    """Pairs of members whose values differ by at most ``radius`` bits (Walsh-Hadamard convolution of the counts)."""
    def transform(x: np.ndarray) -> np.ndarray:
        x, h = x.copy(), 1
        while h < len(x):
            y = x.reshape(-1, 2, h)
            x = np.stack([y[:, 0] + y[:, 1], y[:, 0] - y[:, 1]], axis=1).ravel()
            h *= 2
        return x

    width = int(np.log2(len(counts)))
    near = np.zeros(len(counts))
    near[ball(width, radius)] = 1
    return float((transform(transform(counts) * transform(near)) / len(counts) * counts).sum())


def allocate(cost: np.ndarray, distance: int) -> list[int]:
    """Thresholds t_i in -1..distance with sum(t_i + 1) = distance + 1 and the least ``cost[i, t_i + 1]`` in all."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for give in range(distance + 2 - used):
                cand = (c + float(row[give]), [*ts, give - 1])
                if used + give not in nxt or cand < nxt[used + give]:
                    nxt[used + give] = cand
        best = nxt
    return best[distance + 1][1]


def plan_partitions(distinct: DataFrame, distance: int, parts: int) -> tuple[list[list[int]], list[int]]:
    """Bit partitions and thresholds from the statistics of all distinct fingerprints."""
    if 64 // parts > 16:
        raise ValueError("at least 4 partitions: the value counts of one must fit the driver")
    n, both = bit_products(distinct)
    bits = group_bits(n, both, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(b), np.int64) for b in bits]
        for batch in batches:
            rows = _bits(batch.column(0).to_numpy()).astype(np.int64)
            for total, places in zip(totals, bits):
                total += np.bincount(rows[:, places] @ (1 << np.arange(len(places))), minlength=len(total))
        for k, total in enumerate(totals):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total[at])],
                                             ["part", "value", "n"])

    # at most parts * 2**16 rows, whatever the input
    rows = (distinct.select("fp").mapInArrow(run, "part int, value long, n long")
            .groupBy("part", "value").agg(F.sum("n").alias("n")).toPandas())
    cost = np.zeros((parts, distance + 2))
    for k, places in enumerate(bits):
        mine = rows[rows["part"] == k]
        counts = np.zeros(1 << len(places))
        counts[mine["value"]] = mine["n"]
        for t in range(distance + 1):
            cost[k, t + 1] = pairs_within(counts, t) + n * len(ball(len(places), t))  # candidates and probes
    return bits, allocate(cost, distance)


# --- links ------------------------------------------------------------------------

def _forest(key: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of equal key (rows sorted by key) that steps of at most ``distance`` bits connect: each with one of them."""
    n = len(fps)
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    end = np.repeat(np.append(edge[1:], n), np.diff(np.append(edge, n)))  # end of each row's bucket
    label = np.arange(n)
    a = np.arange(n)
    step = 0
    while True:
        step += 1
        a = a[a + step < end[a]]
        if not len(a):
            break
        b = a + step
        near = np.bitwise_count((fps[a] ^ fps[b]).view(np.uint64)) <= distance  # of a signed number it counts the magnitude
        x, y = a[near], b[near]
        while True:
            lx, ly = label[x], label[y]
            open_ = lx != ly
            if not open_.any():
                break
            x, y, lx, ly = x[open_], y[open_], lx[open_], ly[open_]
            low = np.minimum(lx, ly)
            np.minimum.at(label, lx, low)
            np.minimum.at(label, ly, low)
            while True:  # flatten
                up = label[label]
                if (up == label).all():
                    break
                label = up
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _bucket_links(keys: DataFrame, key: str, distance: int, partitions: int) -> DataFrame:
    """Links (u, v) inside the buckets of ``keys`` (key, fp): rows dealt and sorted by key, buckets never cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            u, v = _forest(k, f, distance)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            k = np.concatenate([held_key, batch.column(0).to_numpy()])
            f = np.concatenate([held, batch.column(1).to_numpy()])
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last bucket may go on
            if cut:
                yield links(k[:cut], f[:cut])
            held_key, held = k[cut:], f[cut:]
        if len(held):
            yield links(held_key, held)

    return (keys.select(key, "fp").repartition(partitions, key).sortWithinPartitions(key)
            .mapInArrow(run, "u long, v long"))


def _hub_links(rows: DataFrame, free: list[int], distance: int) -> DataFrame:
    """Links inside buckets of any size, without pairs.

    ``rows``: (bucket, fp); members of a bucket can differ only in the ``free``
    bits.  If two members are at most ``distance`` = r + s bits apart (r <= s),
    some x is within r bits of one and s of the other.  So each member visits
    every x within s bits; where a member within r bits stands (the hub), all
    visitors are at most r + s bits from it and link to the least such hub.
    At most one ball of members meets at an x.
    """
    r = distance // 2
    s = distance - r
    masks = np.array([sum(1 << b for b in some) for k in range(s + 1) for some in combinations(free, k)], np.uint64)
    close = sum(1 for k in range(r + 1) for _ in combinations(free, k))  # masks of at most r bits come first
    visits = rows.select("bucket", "fp", F.posexplode(F.array(*[F.lit(int(m)) for m in masks.view(np.int64)])))
    visits = visits.select("bucket", "fp", F.col("fp").bitwiseXOR(F.col("col")).alias("x"),
                           F.when(F.col("pos") < close, F.col("fp")).alias("near"))
    hub = F.min("near").over(Window.partitionBy("bucket", "x"))
    return (visits.select(F.col("fp").alias("u"), hub.alias("v")).filter("v IS NOT NULL AND u <> v").distinct())


def near_links(distinct: DataFrame, distance: int = DISTANCE, parts: int = PARTS,
               bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that connect exactly those within ``distance`` bits.

    A bucket's links join each member to the least of those it reaches inside
    the bucket, so a link may be longer than ``distance``; its ends are
    connected by steps that are not.
    """
    width = shuffle_width(distinct.sparkSession)
    bits, thresholds = plan_partitions(distinct, distance, parts)
    probes = []
    for k, (places, t) in enumerate(zip(bits, thresholds)):
        if t >= 0:
            masks = F.array(*[F.lit(m).cast("long") for m in ball(len(places), t)])
            probes.append(distinct.select("fp", value_of(F.col("fp"), places).alias("own"), F.explode(masks).alias("mask"))
                          .select("fp", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
                          .select((F.col("value") * parts + k).alias("key"), "fp"))
    keys = probes[0]
    for p in probes[1:]:
        keys = keys.unionByName(p)

    def large(rows: DataFrame, key: str) -> DataFrame:
        return materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bucket_rows)
                           .select(key), "large-buckets")

    crowded = large(keys, "key")
    if crowded.isEmpty():
        return _bucket_links(keys, "key", distance, width)
    # members of a crowded bucket again, by an exact match on one of ``distance`` + 1 shares of the other bits
    finer, shares = None, []
    for k, places in enumerate(bits):
        rest = [b for b in range(64) if b not in places]
        mine = keys.join(crowded.filter(F.col("key") % parts == k), "key", "left_semi")
        for j in range(distance + 1):
            share = rest[j::distance + 1]
            one = mine.select(F.lit(len(shares)).alias("split"), "fp",
                              F.xxhash64("key", F.lit(j), value_of(F.col("fp"), share)).alias("bucket"))
            # a threshold of 0 is an exact match on the partition too
            shares.append([b for b in range(64) if b not in share and (thresholds[k] > 0 or b not in places)])
            finer = one if finer is None else finer.unionByName(one)
    finer = materialize(finer.distinct(), "finer-buckets")
    dense = large(finer, "bucket")
    out = (_bucket_links(keys.join(crowded, "key", "left_anti"), "key", distance, width)
           .unionByName(_bucket_links(finer.join(dense, "bucket", "left_anti"), "bucket", distance, width)))
    if not dense.isEmpty():
        for split, free in enumerate(shares):
            out = out.unionByName(_hub_links(finer.filter(F.col("split") == split).join(dense, "bucket", "left_semi"),
                                             free, distance))
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id reachable over links) of all ``docs``.

    Words are what ASCII white space separates, A-Z lower-cased; a shingle is
    ``shingle`` of them joined by blanks (fewer words: all of them).  NULL and
    empty texts have fingerprint zero and link like any other.  Repeated rows
    keep a row each; a NULL doc_id is ignored when the least is taken.  Copies
    are one fingerprint before anything is compared, so a group of copies of
    any size costs one row.
    """
    return _linked(docs, shingle, distance, parts).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _linked(docs: DataFrame, shingle: int, distance: int, parts: int) -> DataFrame:
    """doc_id, fp, root and component_id of each row (and _row, where ``docs`` has it)."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(near_links(distinct.select("fp"), distance, parts))
    rooted = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.select("fp", "root").join(least, "root"), "fp")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """The row of each component that stays, with its columns: the least doc_id (NULL last), then the first row."""
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    kept = (_linked(rows, shingle, distance, parts).groupBy("root")
            .agg(F.min_by("_row", order).alias("_row")).select("_row"))
    return rows.join(kept, "_row", "left_semi").drop("_row")


ship_by_value(__name__)
