"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodgeworks.catalog import QUERIES, learning  # noqa: E402
from lodgeworks.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_cancellation_by_month",
    "clean_bookings_full",
    "a1_distinct_rows",
    "a2_duplicate_count",
    "a4_null_counts",
    "a9_modes",
    "a10_quartiles",
    "a11_iqr_outliers",
    "f1_repair_date",
    "f8_fill_nulls",
    "f3_label_encoding",
    "f3_label_encoding_large_dictionary",
    "t3_contiguous_ids",
    "v3_schema_findings",
    "v4_quality_report",
    "v13_feature_table",
    "j1_as_of_join",
    "j2_as_of_join_two_views",
    "j3_request_join",
    "p13_service_v1",
    "st2_snapshot",
    "a24_feature_drift",
    "a24_feature_drift_bookings",
    "fs7_monitor_rows",
    "a19_box_stats_by_segment",
    "a21_class_report",
    "f15_standard_scaling",
    "st5_request_metrics",
    "m7_logistic_regression",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JVM's compilation and opens the files.
    QUERIES["flagship_cancellation_by_month"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            learning.forget()  # every timed run fits its own model
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(sorted(taken)[len(taken) // 2], 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
