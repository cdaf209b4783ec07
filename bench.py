"""Headline queries, each written out cold and then warm; one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1), BENCH_CPUS: cores (default 8). A time is that of the second run; the
first ones, cold, stand beside it. The yearly-file rate reads, averages and writes what a yearly file holds, one a (scenario, year).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from stratus.operators.climatology import daily_climatology
from stratus.plans.catalogue import queries
from stratus.plans.testbed import obs

HEADLINE = ("daily_climatology", "climate_normal", "hybrid_normal", "planned_normals", "normal_of_30_years", "annual_mean_temp", "growing_degree_days", "annual_precip", "hot_days_p90", "cold_days_p5", "wet_days_p95", "all_metrics", "metrics_wide", "box_stats", "box_percentiles", "exact_quantiles", "seasonal_means", "yoy_extremes", "monotonic", "issue_counts", "precip_patterns", "outliers_iqr", "outliers_zscore", "outliers_modz", "outlier_findings", "scenario_change", "histogram", "task_status", "year_coverage", "zonal_mean", "box_join")


def main() -> None:
    data, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, target = queries(), tempfile.mkdtemp(prefix="spark-", dir="/tmp")

    def written(make) -> float:
        """Seconds from the query's call, with the passes that it runs itself, to its written result."""
        began = time.perf_counter()
        make().write.mode("overwrite").parquet(f"{target}/out")
        return round(time.perf_counter() - began, 3)

    cold, warm = {}, {}
    for name in HEADLINE:
        cold[name], warm[name] = (written(lambda name=name: known[name](spark, data)) for _ in range(2))
    rows = obs(spark, data)
    readings, files = rows.count(), rows.select("scenario", "year").distinct().count()
    seconds = min(written(lambda: daily_climatology(rows, "tas", ("scenario", "year"))) for _ in range(2))
    rate = {"yearly_files_per_sec": round(files / seconds, 2), "rows_a_file": readings // max(1, files), "rows_per_sec": round(readings / seconds)}
    print(json.dumps({"metric": "headline_total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold, "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), **rate}))
    spark.stop()


if __name__ == "__main__":
    main()
