"""Benchmark the headline queries.

Runs each query once to warm up (JIT, telemetry materialisation), then three
timed runs that execute the full plan into the ``noop`` sink (nothing is
collected to the driver), and prints ONE JSON line with the medians.

    BENCH_SF_DIR  (default /root/testdata/sf0.1)
    BENCH_CPUS    (default 8)
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "rolling_features_E1": "e1_rolling_features",
    "threshold_sweep_D18": "d18_threshold_sweep",
    "deadband_alarm_E8": "e8_deadband_latch",
    "alert_construction_J16": "j16_alert_stream",
    "run_detection_metrics_D11": "d11_run_detection_metrics",
    "flagship": "flagship_run_report",
    "feature_matrix_572_E1": "e1_full_feature_matrix",
    "alarm_episodes_E10": "e10_alarm_episodes",
    "alarm_kpis_D23": "d23_alarm_kpis",
    "model_comparison_D26": "d26_model_comparison",
    "median_trajectory_D7": "d7_median_trajectory",
    "stream_latch_K3": "k3_stream_deadband_latch",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from faultline.plans import registry
    from faultline.session import get_spark

    spark = get_spark(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="faultline-bench")
    registry.load_all()
    times: dict[str, float] = {}
    for label, name in HEADLINE.items():
        fn = registry.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[label] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_queries_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
