"""Conversation prefix trie: a z-fast trie over turn sequences, as Spark tables.

A conversation is the sequence of its turns (role, text), and a prefix of d
turns has a key: a chained hash of its turns, 16 bytes.  The trie is kept
compacted.  A row of the node table stands for the edge that ends in a node
where a conversation ends or paths part: its extent (the path from the root),
the depth ``pd`` of its parent and its own depth ``ed``.  Its handle is the
prefix of the extent whose depth is the two-fattest number in (pd, ed], the
one divisible by the largest power of two.

* **Locating.**  A conversation's exit node is found by fat binary search: look
  up the prefix at the two-fattest depth f of what is left of (l, r].  A handle
  found there moves l down to its node's depth; without one, r becomes f - 1.
  Each step is one equi-join of all conversations of a batch on the handle, and
  there are as many as the longest conversation's depth has bits.
* **Inserting.**  Distinct conversations are inserted in batches, the first ones
  small, so that common beginnings are found in the trie later on.  A batch
  cuts the edges inside which its conversations leave, and what is new to the
  trie is compacted: a new prefix is a node when a conversation ends there or
  it has two different next turns.  One conversation of those that share a new
  edge owns it.
* **Expanding.**  Every edge becomes its prefixes, one row each; what holds for
  a whole edge (members, leaves) is counted once per edge.

Texts are hashed where they are read; only hashes and lengths are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.pyworker import ship_by_value
from sifter.llm.common import materialize, only, shuffle_width

KEY_BYTES = 16
ROOT = hashlib.sha256(b"root").digest()[:KEY_BYTES]
HEADS = 6  # a conversation takes over crc32(id) % HEADS turns of its first relative
FAMILY = 100  # ids from one multiple of it to the next are relatives
SHARES = 16  # distinct conversations are dealt into so many shares by hash,
BATCH_ENDS = (1, 4, 16)  # and inserted in batches that end at these shares
CHUNK_BYTES = 8192
NODE_SCHEMA = "key binary, pd int, ed int, p array<binary>, c array<long>"


# --- conversations ------------------------------------------------------------------

def turn_hash(role: Column, text: Column) -> Column:
    """16 bytes for (role, text); the role's length keeps the border between them."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * KEY_BYTES))


def rebuilt_turns(conversations: DataFrame, heads: int = HEADS, family: int = FAMILY) -> DataFrame:
    """(conv_id, turns): each conversation with the first turns of its family's first one in place of its own.

    ``turns`` holds (hash, code points) in the order of turn, NULL first; equal
    turn numbers are ordered by hash.  Rows with a NULL conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = only(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", turn_hash(role, text).alias("k"), F.length(text).cast("long").alias("n")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    own = own.withColumn("own", F.transform("own", lambda t: F.struct(t["k"].alias("k"), t["n"].alias("n"))))
    own = materialize(own, "own-turns")
    first = own.filter(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_first"), F.slice("own", 1, heads).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    both = own.withColumn("_first", F.col("conv_id") - F.col("conv_id") % family).join(first, "_first", "left")
    kept = F.coalesce(F.slice("head", F.lit(1), h.cast("int")), F.slice("own", 1, 0))
    return both.select("conv_id", F.concat(kept, F.slice("own", h.cast("int") + 1, F.size("own"))).alias("turns"))


def prefix_keys(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, p, c, end): keys of all prefixes from one turn on, their code points, and the last key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column(1)
            sizes = np.diff(turns.offsets.to_numpy())
            flat = turns.flatten()
            keys, ends, at = [], [], 0
            hashes = flat.field(0).to_pylist()
            for size in sizes.tolist():
                key = ROOT
                for k in hashes[at:at + size]:
                    key = hashlib.sha256(key + k).digest()[:KEY_BYTES]
                    keys.append(key)
                ends.append(key)
                at += size
            total = np.cumsum(flat.field(1).to_numpy())
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            before = np.concatenate([[0], total])[offsets[:-1]]
            cuts = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(cuts, pa.array(keys, pa.binary())),
                 pa.ListArray.from_arrays(cuts, pa.array(total - np.repeat(before, sizes), pa.int64())), pa.array(ends, pa.binary())],
                ["conv_id", "p", "c", "end"])

    return rebuilt.mapInArrow(run, "conv_id long, p array<binary>, c array<long>, end binary")


# --- the trie -----------------------------------------------------------------------

def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1), F.length(F.bin(low.bitwiseXOR(high).cast("long"))) - 1))


def empty_trie(spark) -> DataFrame:
    return spark.createDataFrame([(ROOT, -1, 0, [], [])], NODE_SCHEMA)


def locate(nodes: DataFrame, strings: DataFrame, longest: int) -> DataFrame:
    """``strings`` (end, p, c) with l (depth of the last node on the path), xkey (the node whose edge is left
    inside, NULL when there is none) and lcp (turns shared with the trie)."""
    handles = nodes.filter("ed > 0").select(
        F.element_at("p", two_fattest(F.col("pd"), F.col("ed"))).alias("_h"),
        F.col("key").alias("_key"), F.col("pd").alias("_pd"), F.col("ed").alias("_ed"))
    size = F.size("p")
    s = strings.select("end", "p", "c", F.lit(0).alias("l"), size.alias("r"))
    for _ in range(longest.bit_length()):
        left = F.col("l") < F.col("r")
        f = F.when(left, two_fattest(F.col("l"), F.col("r")))
        # a row that has been located asks for its own end: its answer is not read, and no key is shared by all of them
        s = s.withColumn("_f", f).withColumn("_ask", F.when(left, F.element_at("p", F.coalesce("_f", F.lit(1)))).otherwise(F.col("end")))
        s = s.join(handles, s["_ask"] == handles["_h"], "left")
        found = left & F.col("_h").isNotNull()
        inside = (F.col("_ed") <= size) & (F.element_at("p", F.greatest(F.least("_ed", size), F.lit(1))) == F.col("_key"))
        s = s.select(
            "end", "p", "c",
            F.when(found & inside, F.col("_ed")).when(found, F.col("_pd")).otherwise(F.col("l")).alias("l"),
            F.when(found & inside, F.col("r")).when(found, F.col("_pd")).when(left, F.col("_f") - 1).otherwise(F.col("r")).alias("r"))
    edges = nodes.filter("ed > 0").select(F.element_at("p", F.col("pd") + 1).alias("_first"), F.col("key").alias("xkey"),
                                          F.col("p").alias("_q"))
    on = F.col("l") < size
    s = s.withColumn("_ask", F.when(on, F.element_at("p", F.least(F.col("l") + 1, F.greatest(size, F.lit(1))))).otherwise(F.col("end")))
    s = s.join(edges, s["_ask"] == edges["_first"], "left")
    # chained keys are equal exactly as far as the paths are
    same = F.size(F.filter(F.zip_with("p", "_q", lambda a, b: a == b), lambda x: x))
    met = on & F.col("xkey").isNotNull()
    return s.select("end", "p", "c", "l", F.when(met, F.col("xkey")).alias("xkey"), F.when(met, same).otherwise(F.col("l")).alias("lcp"))


def cut_edges(nodes: DataFrame, located: DataFrame) -> DataFrame:
    """The node table with a node wherever a located string leaves an edge inside."""
    cuts = located.filter("xkey IS NOT NULL").groupBy("xkey").agg(F.collect_set("lcp").alias("_cuts"))
    both = nodes.join(cuts, nodes["key"] == cuts["xkey"], "left")
    inner = F.array_sort(F.filter(F.coalesce("_cuts", F.array().cast("array<int>")),
                                  lambda d: (d > F.col("pd")) & (d < F.col("ed"))))
    both = both.withColumn("_at", F.concat(F.array("pd"), inner, F.array("ed")))
    part = both.select("*", F.explode(F.sequence(F.lit(1), F.size("_at") - 1)).alias("_i"))
    low, high = F.element_at("_at", F.col("_i")), F.element_at("_at", F.col("_i") + 1)
    return part.select(F.when(high == F.col("ed"), F.col("key")).otherwise(F.element_at("p", F.greatest(high, F.lit(1)))).alias("key"),
                       low.alias("pd"), high.alias("ed"), F.slice("p", F.lit(1), high).alias("p"), F.slice("c", F.lit(1), high).alias("c"))


def new_edges(located: DataFrame) -> DataFrame:
    """Nodes and edges for what the located strings have beyond the trie, compacted."""
    tails = located.filter(F.col("lcp") < F.size("p")).select(
        "end", "p", F.explode(F.sequence(F.col("lcp") + 1, F.size("p"))).alias("d"))
    child = F.when(F.col("d") < F.size("p"), F.element_at("p", F.least(F.col("d") + 1, F.size("p"))))
    tails = tails.select("end", "d", F.element_at("p", F.col("d")).alias("k"), child.alias("child"))
    marks = tails.groupBy("k").agg(F.min("child").alias("_a"), F.max("child").alias("_b"), F.count("child").alias("_on"),
                                   F.count(F.lit(1)).alias("_all"), F.min("end").alias("owner"))
    marks = materialize(marks.filter("_on < _all OR _a <> _b").select("k", "owner"), "trie-marks")
    # both sides are plain tables: adaptive execution can split a beginning that very many strings share
    ends = tails.select("end", "d", "k").join(marks, "k").groupBy("end").agg(
        F.sort_array(F.collect_list(F.struct("d", (F.col("owner") == F.col("end")).alias("own")))).alias("_ends"))
    both = located.join(ends, "end")
    part = both.select("p", "c", "lcp", "_ends", F.posexplode("_ends").alias("_i", "_e")).filter("_e.own")
    low = F.when(F.col("_i") > 0, F.element_at("_ends", F.greatest(F.col("_i"), F.lit(1)))["d"]).otherwise(F.col("lcp"))
    high = F.col("_e.d")
    return part.select(F.element_at("p", high).alias("key"), low.alias("pd"), high.alias("ed"),
                       F.slice("p", F.lit(1), high).alias("p"), F.slice("c", F.lit(1), high).alias("c"))


def insert(nodes: DataFrame, strings: DataFrame, longest: int) -> DataFrame:
    """The node table with a batch of distinct ``strings`` (end, p, c) inserted."""
    located = materialize(locate(nodes, strings, longest), "trie-located")
    return materialize(cut_edges(nodes, located).unionByName(new_edges(located)), "trie-nodes")


def build_trie(strings: DataFrame, batch_ends: tuple[int, ...] = BATCH_ENDS) -> DataFrame:
    """The compacted trie (key, pd, ed, p, c) of all distinct ``strings``; its root is a node at depth 0."""
    spark = strings.sparkSession
    longest = strings.agg(F.coalesce(F.max(F.size("p")), F.lit(0))).first()[0]
    share = F.pmod(F.xxhash64("end"), F.lit(SHARES))
    nodes, last = empty_trie(spark), 0
    for end in batch_ends:
        nodes = insert(nodes, strings.filter((share >= last) & (share < end)), longest)
        last = end
    return nodes


# --- counts and rows ----------------------------------------------------------------

def ends_digest(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's member ids in ascending order, comma-joined.

    The ids are range-dealt by (key, id), so those of one key are spread over
    tasks, which join them into chunks of text.  A key's chunks are hashed one
    after the other as they stream by; none is held with the others.
    """
    dealt = members.repartitionByRange(shuffle_width(members.sparkSession), "end", "conv_id").sortWithinPartitions("end", "conv_id")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0
        out: list[tuple[bytes, int, bytes]] = []
        for batch in batches:
            for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (end != key or size >= CHUNK_BYTES):
                    out.append((key, first, ",".join(held).encode()))
                    held, size = [], 0
                if not held:
                    key, first = end, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            yield rows(out)
            out = []
        if held:
            yield rows([(key, first, ",".join(held).encode())])

    def rows(out: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                          ["end", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for end, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if end != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = end, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield digests(done)
        if state:
            yield digests([(key, state.hexdigest())])

    def digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        cols = list(zip(*done)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())], ["key", "ends_sha256"])

    parts = dealt.mapInArrow(chunks, "end binary, first long, ids binary")
    return parts.repartition("end").sortWithinPartitions("end", "first").mapInArrow(digest, "key binary, ends_sha256 string")


def trie_rows(nodes: DataFrame, strings: DataFrame, digests: DataFrame) -> DataFrame:
    """Every prefix in the trie with its counts: the edges expanded."""
    path = F.concat(F.array(F.lit(ROOT)), F.col("p"))
    members = strings.select(F.explode(path).alias("key"), "n", "least").groupBy("key").agg(
        F.sum("n").alias("n_convs"), F.min("least").alias("conv_id"))
    parent = F.when(F.col("pd") > 0, F.element_at("p", F.greatest("pd", F.lit(1)))).when(F.col("pd") == 0, F.lit(ROOT))
    kids = nodes.select(parent.alias("key")).filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("kids"))
    counted = materialize(nodes.join(members, "key").join(kids, "key", "left").join(digests, "key", "left")
                          .withColumn("pkey", parent), "trie-counted")
    before = F.when(F.col("pd") > 0, F.element_at("c", F.greatest("pd", F.lit(1)))).otherwise(F.lit(0))
    through = F.when(F.col("ed") > 0, F.element_at("c", F.greatest("ed", F.lit(1)))).otherwise(F.lit(0))
    below = counted.select(F.explode(path).alias("key"), ((F.col("n_convs") - 1) * (through - before)).alias("w"),
                           F.col("kids").isNull().cast("long").alias("leaf")).groupBy("key").agg(
        F.sum("w").alias("saved"), F.sum("leaf").alias("n_leaves"))
    up = counted.select(F.col("key").alias("pkey"), F.col("conv_id").alias("up_conv"))
    whole = counted.join(below, "key").join(up, "pkey", "left")
    d = F.col("depth")
    some = whole.select("*", F.explode(F.sequence(F.col("pd") + 1, F.col("ed"))).alias("depth"))
    above = F.when(d > 1, F.element_at("c", F.greatest(d - 1, F.lit(1)))).otherwise(F.lit(0)) - before
    top, bottom = d == F.col("pd") + 1, d == F.col("ed")
    return some.select(
        "conv_id", d.cast("long").alias("depth"),
        F.when(d > 0, F.when(top, F.col("up_conv")).otherwise(F.col("conv_id"))).alias("parent_conv_id"),
        "n_convs", F.when(bottom, F.coalesce("kids", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        F.when(d > 0, F.col("saved") - (F.col("n_convs") - 1) * above).otherwise(F.col("saved")).alias("saved_tokens"),
        F.coalesce(F.when(bottom, F.col("ends_sha256")), F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, heads: int = HEADS, family: int = FAMILY,
                batch_ends: tuple[int, ...] = BATCH_ENDS) -> DataFrame:
    """One row per prefix of the rebuilt ``conversations`` (conv_id, turn, role, text).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  NULL roles and texts are
    empty; rows with a NULL conv_id are left out; repeated rows are turns of
    their own; equal turn numbers are ordered by a hash of role and text.  A
    conversation without turns ends in the root.  An empty table gives no rows.

    A conversation's keys (24 bytes a turn) travel in one row.  Building the
    frame inserts the batches, each into a written node table.
    """
    rebuilt = materialize(prefix_keys(rebuilt_turns(conversations, heads, family)), "rebuilt")
    strings = materialize(rebuilt.groupBy("end").agg(F.any_value("p").alias("p"), F.any_value("c").alias("c"),
                                                     F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")), "strings")
    return trie_rows(build_trie(strings, batch_ends), strings, ends_digest(rebuilt.select("end", "conv_id")))


ship_by_value(__name__)
