"""Times the headline queries and prints one JSON line.

Each query runs twice and the second run counts: the first one compiles code, which on tables of this
size takes longer than the work. First-run times are reported beside it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskflow.plans import catalog  # noqa: E402
from riskflow.session import local_session  # noqa: E402
from riskflow.sources import derived  # noqa: E402

HEADLINE = [
    "risk_by_split_and_diagnosis", "patient_split", "violation_report", "dataset_checks", "quarantine",
    "clean_features", "scale_stats", "onehot_vocab", "lace_scores", "model_comparison", "recall_at_k",
    "fairness_gap", "gate_checks", "feature_drift", "prediction_drift", "concept_drift", "monitor_snapshot",
    "latest_labels", "label_join", "retrain_dataset", "request_rate", "latency_quantiles", "sustained_alerts",
    "slo_report", "data_version", "isotonic_rates", "first_split_gains", "experiments", "batch_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1).collect()
    times: dict[str, float] = {}
    queries = catalog.queries()
    start = time.perf_counter()
    derived.encounters(spark, sf_dir)  # the stored encounter table, which the queries then read
    times["build_encounter_table"] = round(time.perf_counter() - start, 3)
    first: dict[str, float] = {}
    for name in HEADLINE:
        for runs in (first, times):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "first_run": first, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
