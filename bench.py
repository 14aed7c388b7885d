"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` an optional
comma-separated choice (``all`` for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "encounter_kpi_g01", "patient_summary_g02", "encounter_summary_g03", "patient_timeline_g04", "demographic_timeline_g05", "medication_summary_g06",
    "patient_health_summary_g10_a18", "patient_narrative_n01", "flatten_observation_p12", "observation_gold_r11", "raw_extract_p21_j07", "wide_dataset_j09", "cohort_j12_j13_j14",
    "asof_join_j16", "resolve_references_j18", "describe_a44", "condition_summary_g09_a16", "metric_stats_a20_a21_q34", "metric_trends_a22_w10", "alert_history_t08",
    "expectations_q26_q28_q29", "declared_rules_q05", "assessment_q19_q20_q21_q22_q23_q24_q25", "patient_to_gold_e08_e11_e12", "mask_pii_c39", "upsert_k05_u04", "metric_stream_t07",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from medtable.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else ([n for n in chosen.split(",") if n] or HEADLINE)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("medtable-bench").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip('/'))}))
    spark.stop()


if __name__ == "__main__":
    main()
