"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import drop_table, materialize


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node of its neighbourhood."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) that is not its component's least node.

    Links may be repeated and in either direction; a link to itself says
    nothing.  Each step sums by node before it is shuffled, a node with very
    many links is a skewed join side that adaptive execution splits, and each
    round's links are written under the shared folder.
    """
    now = materialize(links.filter("u <> v").select("u", "v").distinct(), "links")
    state = _fingerprint(now)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        after = materialize(_small_star(_large_star(now)), "links")
        new_state = _fingerprint(after)
        drop_table(now.sparkSession, now)
        now, state, same = after, new_state, new_state == state
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
