"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is run to completion (result written to a no-op sink via count of
the full result) after one warm-up of the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sessionlab.config import build_session  # noqa: E402
from sessionlab.plans.registry import REGISTRY  # noqa: E402

# phase 1 (events -> sessions, exact and monthly-merge, wide view), phase 2
# (features), evaluation, splits, audit
HEADLINE = ["sessions_all", "sessions_wide", "monthly_merge", "add_features", "univariate_auc", "roc_auc",
            "classification_report", "stratified_split", "feature_summary", "audit_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = build_session(f"local[{cpus}]", app="sessionlab-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g", "spark.default.parallelism": cpus})
    # warm-up (untimed): one pass of the same queries over the smallest tables
    # so JIT and codegen caches are hot, as in a long-lived cluster session
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            REGISTRY[n].build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        df = REGISTRY[n].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None,
                      "warmup": warm_dir if os.path.isdir(warm_dir) else None}))
    spark.stop()


if __name__ == "__main__":
    main()
