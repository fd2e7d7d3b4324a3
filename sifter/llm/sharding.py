"""Sharding by a hierarchical weighted hash tree (region, rack, shard).

A document descends the tree from the root.  At each level every child draws
``-ln(u) / weight`` with ``u`` a hash of (document, child) in (0, 1), and the
smallest draw wins.  A draw depends on nothing but the document, the child's
name and the child's weight, so a change of the tree moves rows only through
the children whose weight changed; a subtree that is added under the root
takes rows only into itself.  ``layout`` grows that way: shards past the base
tree open regions of their own, so for every count of shards beyond the base
the next shard takes rows only into itself.

Everything here is built-in SQL functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.common import materialize, only, utf8

BASE_SHAPE = (2, 2, 2)  # regions, racks in each, shards in each rack
ROWS_PER_CELL = 50_000
DRAW_BITS = 52


@dataclass(frozen=True)
class Node:
    """A tree node: inner nodes have children, a leaf has its shard number."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int = -1
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def layout(shards: int, shape: Sequence[int] = BASE_SHAPE, weights: Sequence[float] | None = None) -> Node:
    """The tree for ``shards`` equal (or weighted) shards: base tree first, then one region per further shard."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    weights = list(weights) if weights is not None else [1.0] * shards
    if len(weights) != shards or any(not w > 0 for w in weights):
        raise ValueError("one positive weight for each shard")
    _, racks, per_rack = shape
    base = shape[0] * racks * per_rack
    tree: dict[int, dict[int, list[Node]]] = {}
    for s in range(shards):
        if s < base:
            region, rack = s // (racks * per_rack), s // per_rack
        else:  # a region and a rack of its own
            region, rack = shape[0] + s - base, shape[0] * racks + s - base
        tree.setdefault(region, {}).setdefault(rack, []).append(Node(f"shard{s}", shard=s, own_weight=weights[s]))
    return Node("root", tuple(
        Node(f"region{g}", tuple(Node(f"rack{r}", tuple(leaves)) for r, leaves in kids.items()))
        for g, kids in tree.items()))


def draw(key: Column, node: Node) -> Column:
    """``-ln(u) / weight`` with u from 52 bits of MD5(key/node), never 0 or 1."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/" + node.name)).cast("binary")), 1, DRAW_BITS // 4), 16, 10)
    u = (bits.cast("long").cast("double") + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
    return -F.log(u) / F.lit(float(node.weight))


def descend(key: Column, node: Node) -> Column:
    """The shard that ``key`` reaches below ``node``: the least draw wins, the earlier child on a tie."""
    if not node.children:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return descend(key, node.children[0])
    draws = F.array(*[draw(key, c) for c in node.children])
    won = F.array_position(draws, F.array_min(draws))
    out = descend(key, node.children[-1])
    for i, child in reversed(list(enumerate(node.children[:-1], start=1))):
        out = F.when(won == i, descend(key, child)).otherwise(out)
    return out


def assign_shards(docs: DataFrame, shards: int = 8, shape: Sequence[int] = BASE_SHAPE,
                  weights: Sequence[float] | None = None, grown_weight: float = 1.0) -> DataFrame:
    """All ``docs`` (doc_id, text) with their shard and a gapless place in it.

    Columns: doc_id, size (UTF-8 bytes + 1; NULL text has no bytes),
    text_crc32 (unsigned, of the UTF-8 bytes), law ('key'), shard, slot
    (gapless from 0 in each shard), grown_shard (the shard with one more shard
    of ``grown_weight``).

    The key is doc_id as text; a NULL doc_id is the key 'null'.  Rows with the
    same doc_id go to the same shard; repeated rows keep a slot each.  Empty
    tables give no rows; other columns are left behind.

    Slots: rows are dealt over (shard, cell) with cell a hash of the whole
    slim row, so no task holds a shard.  Cell totals are summed first and the
    rows numbered inside their cell.  The text is read once, hashed, and never
    shuffled: the slim rows are written once under the shared folder.
    """
    if weights is None:
        weights = [1.0] * shards
    small, large = layout(shards, shape, weights), layout(shards + 1, shape, [*weights, grown_weight])
    cells = max(16, -(-docs.count() // (ROWS_PER_CELL * shards)))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    slim = only(docs, "doc_id", "text").select(
        "doc_id",
        (F.length(utf8("text")) + F.lit(1)).cast("long").alias("size"),
        F.crc32(utf8("text")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(key, small).cast("int").alias("shard"),
        descend(key, large).cast("int").alias("grown_shard"),
    ).withColumn("_cell", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(cells)))
    slim = materialize(slim, "shards")
    totals = slim.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("shard").alias("_s"), F.col("_cell").alias("_c"),
                            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return (slim.withColumn("_row", F.row_number().over(inside) - 1)
            .join(offsets, F.expr("shard <=> _s AND _cell <=> _c"))
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("_offset") + F.col("_row")).cast("long").alias("slot"), "grown_shard"))


def shard_moves(before: Node, after: Node, docs: DataFrame) -> DataFrame:
    """Rows and bytes that move from shard to shard when the tree ``before`` becomes ``after``."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return (only(docs, "doc_id", "text")
            .select(descend(key, before).alias("from_shard"), descend(key, after).alias("to_shard"),
                    (F.length(utf8("text")) + 1).cast("long").alias("size"))
            .filter("from_shard <> to_shard")
            .groupBy("from_shard", "to_shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")))
