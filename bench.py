"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  A query is executed in full
with the ``noop`` sink (every row is produced, nothing is collected to the
driver); the time is the median of ``$BENCH_REPEATS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketpulse.session import checkpoint_dir, local_session  # noqa: E402
from marketpulse.plans import catalog  # noqa: E402

HEADLINE = ["resample_ffill", "latest_by_coin", "cooldown", "match_alerts", "sentiment_summary", "score_text",
            "period_stats", "subs_state", "select_articles", "tick_job"]
SCALING = ["resample_ffill", "latest_by_coin", "cooldown", "match_alerts", "sentiment_summary", "score_text"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(int(cpus), 1) * 2))),
                          app="marketpulse-bench")
    checkpoint_dir(spark)  # the configured spark.checkpoint.dir, or a scratch folder when it is unset
    results = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up: JIT, file listing, Python worker start
        results[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "headline_total_median_sec", "value": round(sum(results.values()), 3),
           "unit": "sec", "queries": results, "sf": sf, "cpus": int(cpus)}
    small = os.environ.get("BENCH_SMALL_SF_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01"))
    if not sys.argv[1:] and os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(sf_dir):
        ratio = {}
        for name in SCALING:
            run(spark, name, small)
            t_small = statistics.median(run(spark, name, small) for _ in range(repeats))
            ratio[name] = round(results[name] / t_small, 2)
        out["scaling_vs_sf0.01"] = ratio
    print(json.dumps(out))


if __name__ == "__main__":
    main()
