"""Headline benchmark: moderation throughput by block-list size, plus the main reports.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Every query runs over whole tables and is forced to
completion with the ``noop`` sink (full execution, nothing collected).
Larger block lists are the test list plus rule-made words that never occur,
so the scan has to read every text to its end.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from sifter.plans import catalog  # noqa: E402
from sifter.plans.moderation import moderate  # noqa: E402
from sifter.session import get_session  # noqa: E402
from sifter.sources import testdata as TD  # noqa: E402
from sifter.sources.tables import load_block_list  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARMUP_DIR = "/root/testdata/sf0.001"
BASELINE_MODERATIONS_PER_SEC = 155


def rule_words(n: int) -> list[str]:
    """``n`` pseudo-words made by a rule (hash digests), absent from every text."""
    return [f"zq{hashlib.sha1(str(i).encode()).hexdigest()[:8]}" for i in range(n)]


def words_of_size(spark, k: int):
    base = TD.raw_words(spark)
    extra = spark.createDataFrame([(w,) for w in rule_words(max(0, k - 11))], "word string")
    return load_block_list(spark, base.unionByName(extra))


def _sf_number(path: str):
    tag = os.path.basename(path.rstrip("/")).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_session(f"local[{CPUS}]", app_name="sifter-bench", shuffle_partitions=max(8, 2 * CPUS),
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf = SF_DIR
    n_posts = TD.table(spark, sf, "documents").count()

    def plan_for(d: str) -> dict:
        return {
            "moderate": lambda: catalog.q_moderate(spark, d),
            "moderate_k200": lambda: moderate(TD.tasks(spark, d), words_of_size(spark, 200), TD.users(spark, d)),
            "moderate_k1000": lambda: moderate(TD.tasks(spark, d), words_of_size(spark, 1000), TD.users(spark, d)),
            "word_hits": lambda: catalog.q_word_hits(spark, d),
            "dead_letters": lambda: catalog.q_dead_letters(spark, d),
            "applied_status": lambda: catalog.q_applied_status(spark, d),
            "updated_users": lambda: catalog.q_updated_users(spark, d),
            "moderation_latency": lambda: catalog.q_moderation_latency(spark, d),
            "backlog": lambda: catalog.q_backlog(spark, d),
            "admission": lambda: catalog.q_admission(spark, d),
            "latency_percentiles": lambda: catalog.q_latency_percentiles(spark, d),
            "degraded_in_outage": lambda: catalog.q_degraded_in_outage(spark, d),
        }

    # Warm-up, not timed: every query shape once on the smallest data (JIT, Python workers).
    for build in plan_for(WARMUP_DIR).values():
        run(build())
    run(catalog.consume_task_flushes(spark, WARMUP_DIR, catalog.stage_task_flushes(spark, WARMUP_DIR)))
    plan = plan_for(sf)
    times: dict[str, float] = {}
    for name, build in plan.items():
        t0 = time.perf_counter()
        run(build())
        times[name] = round(time.perf_counter() - t0, 3)
    # The stream: the producer's flushes are staged untimed; the consumer run is timed.
    root = catalog.stage_task_flushes(spark, sf)
    t0 = time.perf_counter()
    run(catalog.consume_task_flushes(spark, sf, root))
    times["moderate_stream"] = round(time.perf_counter() - t0, 3)

    total = round(sum(times.values()), 3)
    rate = {k: round(n_posts / times[k], 1) for k in ("moderate", "moderate_k200", "moderate_k1000",
                                                      "moderate_stream")}
    print(json.dumps({
        "metric": "headline_queries_total_time",
        "value": total,
        "unit": "sec",
        "queries": times,
        "posts_per_sec": rate,
        "baseline_moderations_per_sec": BASELINE_MODERATIONS_PER_SEC,
        "vs_baseline": {k: round(v / BASELINE_MODERATIONS_PER_SEC, 1) for k, v in rate.items()},
        "posts": n_posts,
        "sf": _sf_number(sf),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
