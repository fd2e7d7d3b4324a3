"""R1 as a stream: the token bucket whose state outlives micro-batches.

Each batch reads the buckets of its keys (tokens, time of the last request) as
earlier batches left them, replays its requests with the batch operator, so a
busy key is spread over cells here too, stores the answers and adds the keys'
new buckets to the state table.

* **Late requests.**  A bucket's clock never runs back: a request that is older
  than its key's last one counts as made at that one's time (no refill).
  Inside a batch requests are taken in (time, id) order.
* **Replay.**  Answers overwrite their batch's folder, and the state forgets what
  an earlier attempt of the batch added, so a batch that runs again gives the
  same answers and the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter import constants as K
from sifter.operators.ratelimit import CELL_ROWS, Limit, replay
from sifter.session import checkpoint_root
from sifter.sources.sinks import read_batch, run_id, write_batch
from sifter.streaming.state import StateTable


def last_bucket(rows: DataFrame) -> DataFrame:
    """The bucket of each key as its latest batch left it."""
    return rows.groupBy("key").agg(F.max_by(F.struct("tokens", "t_ms"), "_seq").alias("_b")).select("key", "_b.tokens", "_b.t_ms")


def bucket_table(spark: SparkSession, path: str, key_type: str = "bigint") -> StateTable:
    return StateTable(spark, path, f"key {key_type}, tokens bigint, t_ms bigint", "key", last_bucket)


def admit_batch(spark: SparkSession, requests: DataFrame, batch_id: int, out_path: str, state_path: str, *,
                tokens_per_period: int = K.RATE_PER_SECOND, period_ms: int = 1000, burst: int = K.RATE_BURST,
                cost: int = 1, cell_rows: int = CELL_ROWS) -> None:
    """One micro-batch of ``requests`` (request_id, key, t_ms): answers to ``out_path``, buckets to ``state_path``."""
    kinds, run = dict(requests.dtypes), run_id(spark)
    slim = requests.select(F.col("key").alias("_k"), F.col("t_ms").cast("bigint").alias("_t"), F.col("request_id").alias("_id"))
    table = bucket_table(spark, state_path, kinds["key"])
    before = table.begin(run, batch_id)
    known = table.read(requests.select("key"), before).select(F.col("key").alias("_k"), F.col("tokens").alias("_tokens"), F.col("t_ms").alias("_ts"))
    out = replay(slim, Limit(tokens_per_period, period_ms, burst, cost), cell_rows, known if before["segments"] else None)
    write_batch(out.select(F.col("_id").alias("request_id"), F.col("_k").alias("key"), F.col("_t").alias("counted_ms"),
                           "admitted", "tokens_left"), out_path, batch_id)
    stored = read_batch(spark, out_path, batch_id, f"request_id {kinds['request_id']}, key {kinds['key']}, counted_ms bigint, "
                                                   "admitted boolean, tokens_left bigint")
    table.append(run, batch_id, stored.groupBy("key").agg(
        F.max_by(F.struct("tokens_left", "counted_ms"), F.struct("counted_ms", "request_id")).alias("_b")).select(
        "key", F.col("_b.tokens_left").alias("tokens"), F.col("_b.counted_ms").alias("t_ms")), stored.count())


def admission_stream(spark: SparkSession, requests: DataFrame, out_path: str, state_path: str, *, checkpoint: str | None = None,
                     available_now: bool = True, **limit):
    """R1 (stream): start the query that answers each request of ``requests`` (request_id, key, t_ms)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        admit_batch(spark, batch, batch_id, out_path, state_path, **limit)

    w = requests.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint or checkpoint_root(spark, "admission_stream"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
