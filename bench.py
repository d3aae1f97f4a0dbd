"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once untimed, so that
code generation and file caches are warm, and then BENCH_RUNS times; the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from riskloom.plans import catalogue
from riskloom.session import build_session

QUERIES = (
    "join_identity", "velocity", "time_since", "gap_stats", "rfm", "temporal_all", "agg_card1", "agg_all", "inter_all",
    "freq_encode", "missing_all", "preprocess_pipeline", "describe", "cardinality", "corr_pairs", "row_index",
    "time_split", "stratified_folds", "roc_auc", "rank_blend", "weight_grid", "prediction_profile", "mann_whitney", "cross_validate", "stack_oof",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue.all_queries()
    seconds: dict[str, float] = {}
    for name in QUERIES:
        if name not in known:
            continue
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {"metric": "sum of headline query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "transactions": rows,
              "rows_per_sec": {n: round(rows / s) for n, s in seconds.items()}, "cpus": int(cpus)}
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
