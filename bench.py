"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with per-query seconds.

Each query is executed completely (written to the no-op sink) after one warm-up
query, so the timings cover planning and execution, not result transfer.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabkit.plans.catalog import QUERIES  # noqa: E402
from tabkit.session import get_spark  # noqa: E402

HEADLINE = [
    # profiling and chart data
    "null_counts", "top_values", "distinct_counts", "skewness", "duplicate_rows", "histogram",
    "stacked_counts", "violin_quartiles", "violin_density",
    # preparation and splits
    "exact_split", "impute_median", "standard_scale", "prep_pipeline", "prep_apply_test",
    # evaluation
    "classification_report", "auc_prob", "weighted_precision_recall",
    # i/o
    "csv_scan_header", "parse_labeled_points",
    # results and models
    "best_worst_runs", "early_stop_round", "rf_stump", "lr_predict", "rf_predict", "gbt_predict",
    "svm_predict", "mlp_predict", "text_to_model", "cross_validate", "grid_search", "partition_sweep",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(os.environ.get("BENCH_CPUS", "8"), app="tabkit-bench")
    QUERIES["table_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times, errors = {}, {}
    for name in names:
        t0 = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
