"""Wall time of headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]. Prints one JSON line.

Per query: one warm-up, then the median of three runs, each run to the end into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from driftloom.session import local_session  # noqa: E402
from workload import catalog  # noqa: E402

# query -> table that sets the size of its input
HEADLINE = {
    "contract_split": "customer",
    "missing_patterns": "orders",
    "impute_median": "orders",
    "impute_group_median": "orders",
    "mcar_test": "orders",
    "mice_impute": "orders",
    "knn_impute": "part",
    "cut_quantile": "orders",
    "freq_encode": "lineitem",
    "target_encode": "orders",
    "target_encode_oof": "orders",
    "kpi": "orders",
    "corr_matrix": "lineitem",
    "box_stats": "lineitem",
    "psi_all": "lineitem",
    "ks_w1_all": "lineitem",
    "tvd_chi2_all": "lineitem",
    "drift_report": "lineitem",
    "stratified_folds_shuffled": "orders",
    "auc_exact": "lineitem",
    "threshold_sweep": "lineitem",
    "cv_threshold": "lineitem",
    "soft_vote": "lineitem",
    "last_n_metrics": "events",
    "promote_history": "events",
    "oof_scores": "lineitem",
    "psi_saved_reference": "lineitem",
    "feature_builder": "customer",
    "stream_score": "events",
}


def run(query, spark, sf: str) -> float:
    started = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, partitions, "bench")
    queries = catalog.queries()
    seconds, rates = {}, {}
    for name, table in HEADLINE.items():
        run(queries[name], spark, sf)
        seconds[name] = round(statistics.median(run(queries[name], spark, sf) for _ in range(repeats)), 3)
        rates[name] = round(spark.read.parquet(f"{sf}/{table}.parquet").count() / seconds[name])
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": Path(sf).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
