"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "panel_features_imputed", "w01_lags", "w06_interpolate", "w07_impute", "a03_describe", "a12_corr", "a22_balance",
    "j02_missing_cells", "j05_assemble", "s04_tick_log_scan", "w08_gaps", "w09_log_return", "w10_rolling",
    "w11_sequences", "w13_dedupe_last", "w16_welch", "w17_segments", "w18_cusum", "d01_ols_simple",
    "d02_durbin_watson", "d06_acf", "d08_jarque_bera", "d10_hurst", "m01_zscore", "m10_blend",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from panelflow.suite import QUERIES

    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for n in names:
        took = []
        for _ in range(rounds + 1):  # the first run warms the code cache and is not counted
            start = time.perf_counter()
            QUERIES[n](spark, root).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[n] = round(statistics.median(took[1:] or took), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
