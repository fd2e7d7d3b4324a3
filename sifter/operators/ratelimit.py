"""Token-bucket admission replayed over a request log.

Per key, in (time, request id) order.  The first request finds a full
bucket.  Later: ``tokens = min(burst, tokens + elapsed * rate)``; admit when
``tokens >= cost`` and subtract.  Arithmetic is exact integers: a token is
``period_ms`` units and ``tokens_per_period`` units flow in per millisecond
(200 tokens/s = 200 per 1000 ms).  Input is replayed in sorted order, so a
late caller never gets time refilled twice.

**Cells.**  The log is range-dealt by (key, time, id) into cells of about
``CELL_ROWS`` rows, whatever the keys: a cell holds many small keys, or a
stretch of a busy one.  A cell is replayed in one task; what a stretch needs
from before it is the number of tokens at its first request, its entry.

**Entries by a scan of state maps.**  How a cell maps its entry to its exit is
not monotone (one unit more at the entry can admit one request more), so the
tokens are split into ``level + phase``:

* The *level* is the bucket in which every request takes what it costs or all
  that is left: ``min(burst, . + inflow)``, then ``max(0, . - cost)``.  A cell's
  map of levels is ``min(high, max(low, . + shift))``, three numbers, and such
  maps compose.
* The *phase*, tokens minus level, starts at 0 and stays in [0, cost).  Given
  the levels it only changes near the bottom, where a level below ``cost``
  turns it by that level modulo ``cost``, and near the top, where it is cut to
  ``burst - level``.  A cell's map of phases is piecewise linear; a full bucket
  makes it constant.

So two passes over the stretches of keys that cross a cell border give a few
numbers per cell, a fold over those per key gives all entries, and a third pass
replays all cells at once.  No task folds more rows than its cells have,
however long a key is over or under its rate.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.functions.pyworker import ship_by_value
from sifter.session import write_and_read

CELL_ROWS = 200_000


class Limit:
    """A limiter's numbers, in units: capacity, cost of a request, and inflow per millisecond."""

    def __init__(self, tokens_per_period: int, period_ms: int, burst: int, cost: int):
        self.capacity, self.cost, self.per_ms = burst * period_ms, cost * period_ms, tokens_per_period


class PhaseMap:
    """A map of phases [0, cost) -> [0, cost): pieces that are constant or grow with the phase."""

    def __init__(self, cost: int):
        self.cost = cost
        # (first phase of the piece, value there, 1 if it grows else 0)
        self.pieces = [(0, 0, 1 if cost > 0 else 0)]
        self.turn_by, self.cut_at = 0, None  # of the last run of turns or cuts, not yet applied

    def cut(self, most: int) -> None:
        if self.turn_by:
            self._turn()
        self.cut_at = most if self.cut_at is None else min(self.cut_at, most)

    def turn(self, by: int) -> None:
        if self.cut_at is not None:
            self._cut()
        self.turn_by = (self.turn_by + by) % self.cost

    def _ends(self) -> Iterator[tuple[int, int, int, int]]:
        for i, (start, value, grows) in enumerate(self.pieces):
            yield start, self.pieces[i + 1][0] if i + 1 < len(self.pieces) else max(self.cost, 1), value, grows

    def _put(self, pieces: list[tuple[int, int, int]]) -> None:
        """The pieces, without those that only go on where the one before ends."""
        self.pieces = pieces[:1]
        for p in pieces[1:]:
            start, value, grows = self.pieces[-1]
            if p[2] != grows or p[1] != value + grows * (p[0] - start):
                self.pieces.append(p)

    def _cut(self) -> None:
        most, self.cut_at, out = self.cut_at, None, []
        for start, end, value, grows in self._ends():
            if value >= most:
                out.append((start, most, 0))
            elif grows and value + (end - 1 - start) > most:
                out += [(start, value, 1), (start + most - value, most, 0)]
            else:
                out.append((start, value, grows))
        self._put(out)

    def _turn(self) -> None:
        by, self.turn_by, out = self.turn_by, 0, []
        for start, end, value, grows in self._ends():
            value += by
            if value >= self.cost:
                out.append((start, value - self.cost, grows))
            elif grows and value + (end - 1 - start) >= self.cost:
                out += [(start, value, 1), (start + self.cost - value, 0, 1)]
            else:
                out.append((start, value, grows))
        self._put(out)

    def settled(self) -> list[tuple[int, int, int]]:
        if self.turn_by:
            self._turn()
        if self.cut_at is not None:
            self._cut()
        return self.pieces


def apply_phase(starts: list[int], values: list[int], grows: list[int], phase: int) -> int:
    i = bisect_right(starts, phase) - 1
    return int(values[i]) + (phase - int(starts[i]) if grows[i] else 0)


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Batches that are not empty, each with where a stretch (rows of one _cell and _k) begins."""
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        codes = pd.factorize(pdf["_k"], use_na_sentinel=False)[0]
        cells = pdf["_cell"].to_numpy()
        first, end = ((int(cells[i]), None if pd.isna(pdf["_k"].iat[i]) else pdf["_k"].iat[i]) for i in (0, -1))
        yield pdf, np.concatenate([[first != last], (codes[1:] != codes[:-1]) | (cells[1:] != cells[:-1])])
        last = end


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame]]:
    """Slices of rows of one stretch, with whether each is its first."""
    for pdf, new in _batches(batches):
        cuts = [0, *(np.flatnonzero(new[1:]) + 1).tolist(), len(pdf)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield bool(new[a]), pdf.iloc[a:b]


def _levels(limit: Limit):
    """Pass 1: a row per stretch with its map of levels and its first and last time."""
    b, c, q = limit.capacity, limit.cost, limit.per_ms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        for new, part in _stretches(batches):
            times = part["_t"].tolist()
            if new:
                done.append([part["_k"].iat[0], int(part["_cell"].iat[0]), times[0], times[0], 0, 0, b])
            _, _, _, ts, shift, low, high = done[-1]
            for t in times:
                g = (t - ts) * q
                ts = t
                shift += g - c
                low, high = max(0, min(low + g, b) - c), max(0, min(high + g, b) - c)
            done[-1][3:] = [ts, shift, low, high]
        yield pd.DataFrame(done, columns=["_k", "_cell", "_first", "_last", "_shift", "_low", "_high"])
    return run


def _entry_levels(limit: Limit):
    """The fold over a key's maps of levels, in cell order: the level at each stretch's first request."""
    b, q = limit.capacity, limit.per_ms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = object()
        level = ts = 0
        for pdf in batches:
            entry = []
            for k, first, end, shift, low, high, known in zip(pdf["_k"], pdf["_first"].tolist(), pdf["_last"].tolist(), pdf["_shift"].tolist(),
                                                              pdf["_low"].tolist(), pdf["_high"].tolist(), pdf["_known"]):
                k = None if pd.isna(k) else k
                if k != last:
                    last, level = k, b if pd.isna(known) else int(known)
                else:
                    level = min(b, level + (first - ts) * q)
                entry.append(level)
                level, ts = min(high, max(low, level + shift)), end
            yield pdf[["_k", "_cell"]].assign(_level=np.array(entry, np.int64))
    return run


def _phases(limit: Limit):
    """Pass 2: a row per stretch with its map of phases; each stretch begins with its entry level (``_kind`` 0)."""
    b, c, q = limit.capacity, limit.cost, limit.per_ms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        level, ts, phases = 0, None, None

        def close() -> None:
            starts, values, grows = zip(*phases.settled())
            done[-1] += [list(starts), list(values), list(grows)]

        for new, part in _stretches(batches):
            times, kinds, entries = part["_t"].tolist(), part["_kind"].tolist(), part["_entry"].tolist()
            if new:
                if done:
                    close()
                done.append([part["_k"].iat[0], int(part["_cell"].iat[0])])
                phases, ts = PhaseMap(c), None
            for t, kind, entry in zip(times, kinds, entries):
                if kind == 0:
                    level = entry
                    continue
                if ts is not None:
                    level = min(b, level + (t - ts) * q)
                    if level > b - c:
                        phases.cut(b - level)
                ts = t
                if level < c:
                    phases.turn(level)
                    level = 0
                else:
                    level -= c
        if done:
            close()
        yield pd.DataFrame(done, columns=["_k", "_cell", "_starts", "_values", "_grows"])
    return run


def _entry_tokens(limit: Limit):
    """The fold over a key's maps of phases, in cell order: the tokens at each stretch's first request."""
    b, c = limit.capacity, limit.cost

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, phase = object(), 0
        for pdf in batches:
            entry = []
            for k, level, starts, values, grows in zip(pdf["_k"], pdf["_level"].tolist(), pdf["_starts"], pdf["_values"], pdf["_grows"]):
                k = None if pd.isna(k) else k
                # the inflow before the stretch can fill the bucket up
                phase = min(phase, b - level) if k == last else 0
                last = k
                entry.append(level + phase)
                phase = apply_phase(starts, values, grows, phase) if c > 0 else 0
            yield pdf[["_k", "_cell"]].assign(_entry=np.array(entry, np.int64))
    return run


def _replay(limit: Limit):
    """Pass 3: every request's answer; a stretch without an entry row (``_kind`` 0) begins with a full bucket."""
    b, c, q = limit.capacity, limit.cost, limit.per_ms

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, ts = b, None
        for pdf, new in _batches(batches):
            rows = zip(new.tolist(), pdf["_t"].tolist(), pdf["_kind"].tolist(), pdf["_entry"].tolist())
            admitted, left = np.zeros(len(pdf), bool), np.zeros(len(pdf), np.int64)
            for i, (begins, t, kind, entry) in enumerate(rows):
                if begins:
                    tokens, ts = b, None
                if kind == 0:
                    tokens = entry
                    continue
                if ts is not None:
                    tokens = min(b, tokens + (t - ts) * q)
                ts = t
                if tokens >= c:
                    tokens -= c
                    admitted[i] = True
                left[i] = tokens
            yield pdf[["_k", "_t", "_id"]].assign(admitted=admitted, tokens_left=left)[pdf["_kind"].to_numpy() == 1]
    return run


def replay(slim: DataFrame, limit: Limit, cell_rows: int = CELL_ROWS, state: DataFrame | None = None) -> DataFrame:
    """(_k, _t, _id, admitted, tokens_left) of the requests ``slim`` (_k, _t, _id).

    ``state`` (_k, _tokens, _ts): keys whose bucket is known from before, one
    row a key.  A request of such a key that is older than ``_ts`` counts as
    made at ``_ts``: the bucket's clock never runs back.
    """
    ship_by_value(__name__)
    spark = slim.sparkSession
    kinds = dict(slim.dtypes)
    # keys travel as text and helper rows have no NULLs: whole numbers stay whole on their way through pandas
    slim = slim.withColumn("_k", F.col("_k").cast("string"))
    key, rid = "_k string", f"_id {kinds['_id']}"
    if state is not None:
        state = state.withColumn("_k", F.col("_k").cast("string"))
        s = state.select(F.col("_k").alias("_sk"), "_ts")
        slim = slim.join(s, slim["_k"].eqNullSafe(s["_sk"]), "left").select("_k", F.greatest("_t", "_ts").alias("_t"), "_id")
    cells = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-slim.count() // cell_rows))
    # (key, time, id) is a row of its own, so no key is too busy to be cut
    dealt = write_and_read(slim.repartitionByRange(cells, "_k", "_t", "_id").withColumn("_cell", F.spark_partition_id()), "requests")
    keys = dealt.groupBy("_k").agg(F.min("_cell").alias("_from"), F.max("_cell").alias("_to"), F.min("_t").alias("_first"))
    if state is not None:
        s = state.select(F.col("_k").alias("_sk"), "_tokens", "_ts")
        # in whole numbers that cannot run over: a gap that refills any bucket is as good as a longer one
        gap = F.least(F.col("_first") - F.col("_ts"), F.lit(limit.capacity))
        keys = keys.join(s, keys["_k"].eqNullSafe(s["_sk"]), "left").withColumn(
            "_known", F.when(F.col("_ts").isNotNull(), F.least(F.lit(limit.capacity), F.col("_tokens") + gap * limit.per_ms))) \
            .drop("_sk", "_tokens", "_ts")
    else:
        keys = keys.withColumn("_known", F.lit(None).cast("long"))
    keys = write_and_read(keys.where("_from < _to OR _known IS NOT NULL"), "cut-keys")  # without state at most a key per border
    cut = keys.where("_from < _to").select(F.col("_k").alias("_ck"), "_known")

    def by_cell(rows: DataFrame, *order: str) -> DataFrame:
        return rows.repartition(cells, "_cell").sortWithinPartitions("_cell", "_k", *order)

    def by_key(rows: DataFrame) -> DataFrame:
        return rows.repartition("_k").sortWithinPartitions("_k", "_cell")

    entries = keys.where("_from = _to").select("_k", F.col("_from").alias("_cell"), F.col("_known").alias("_entry"))
    if cut.take(1):
        wide = dealt.join(cut, dealt["_k"].eqNullSafe(cut["_ck"])).select("_k", "_t", "_id", "_cell")
        maps = by_cell(wide, "_t", "_id").mapInPandas(
            _levels(limit), f"{key}, _cell int, _first long, _last long, _shift long, _low long, _high long")
        maps = maps.join(cut, maps["_k"].eqNullSafe(cut["_ck"])).drop("_ck")
        levels = write_and_read(by_key(maps).mapInPandas(_entry_levels(limit), f"{key}, _cell int, _level long"), "levels")
        marked = levels.select("_k", F.lit(0).cast("long").alias("_t"), F.lit(0).cast(kinds["_id"]).alias("_id"), "_cell",
                               F.lit(0).alias("_kind"), F.col("_level").alias("_entry"))
        rows = marked.unionByName(wide.select("*", F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_entry")))
        phases = by_cell(rows, "_kind", "_t", "_id").mapInPandas(
            _phases(limit), f"{key}, _cell int, _starts array<long>, _values array<long>, _grows array<int>")
        p = phases.select(F.col("_k").alias("_pk"), F.col("_cell").alias("_pc"), "_starts", "_values", "_grows")
        both = levels.join(p, levels["_k"].eqNullSafe(p["_pk"]) & (levels["_cell"] == p["_pc"])).drop("_pk", "_pc")
        entries = entries.unionByName(by_key(both).mapInPandas(_entry_tokens(limit), f"{key}, _cell int, _entry long"))
    marked = entries.select("_k", F.lit(0).cast("long").alias("_t"), F.lit(0).cast(kinds["_id"]).alias("_id"), "_cell",
                            F.lit(0).alias("_kind"), "_entry")
    rows = marked.unionByName(dealt.select("_k", "_t", "_id", "_cell", F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_entry")))
    out = by_cell(rows, "_kind", "_t", "_id").mapInPandas(_replay(limit), f"{key}, _t long, {rid}, admitted boolean, tokens_left long")
    return out.withColumn("_k", F.col("_k").cast(kinds["_k"]))


def token_bucket(requests: DataFrame, *, key: str = "key", time_col: str = "t_ms", id_col: str = "request_id",
                 tokens_per_period: int = K.RATE_PER_SECOND, period_ms: int = 1000,
                 burst: int = K.RATE_BURST, cost: int = 1, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Every request with ``admitted`` and ``tokens_left`` (in units of 1/period_ms token).

    ``requests`` needs ``key``, ``time_col`` (epoch ms) and an ``id_col`` that is
    unique per key; other columns are joined back at the end.  Building the
    frame runs jobs: the slim rows are written once with their cells, and so are
    the keys that cross a border and their levels.
    """
    slim = requests.select(F.col(key).alias("_k"), F.col(time_col).cast("bigint").alias("_t"), F.col(id_col).alias("_id"))
    out = replay(slim, Limit(tokens_per_period, period_ms, burst, cost), cell_rows)
    if set(requests.columns) <= {key, id_col}:
        return out.select(*[F.col("_k" if n == key else "_id").alias(n) for n in requests.columns], "admitted", "tokens_left")
    out = out.drop("_t")
    same = requests[key].eqNullSafe(out["_k"]) & requests[id_col].eqNullSafe(out["_id"])
    return requests.join(out, same).select(*requests.columns, "admitted", "tokens_left")
