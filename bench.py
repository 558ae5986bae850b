"""Benchmark the headline pipelines; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query is built and fully executed (noop sink)
once to warm up, then timed BENCH_REPEAT times; the best time is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans import registry  # noqa: E402
from basketry.session import local_session  # noqa: E402

HEADLINE = {
    "p1_feature_generation": "p1_feature_clicks",
    "p3_behaviour_aggregation": "p3_behaviour_order_log",
    "p4_instances_order_log": "w3_order_instances",
    "p4_instances_with_clicks": "p4_instances",
    "p7_recommend_evaluate": "t9_evaluation",
    "t4_similar_items": "t4_similar_items",
}


def run(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    qs = registry.queries()
    times = {}
    for label, name in HEADLINE.items():
        run(spark, qs[name], sf_dir)
        times[label] = round(min(run(spark, qs[name], sf_dir) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_pipelines_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
