"""Time the headline work and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose the
tables and the cores.  Set-up writes the stand-in records as raw CSV and copies the files until
they hold about as many rows as the published timings had, untimed; the
jobs then start from CSV, as they do in use.  ``csv_grouping_counts`` is the
workload of the published timings, from the scan to the written CSV, and
``csv_grouping_counts_published_scale`` the same on all copies.  The jobs run at that scale too, once each.
The first of four count runs warms up and the median of the rest is taken; the queries are the
better of two runs.  ``cleaned_records`` is the time to store the records that the reports read.
"""

from __future__ import annotations

import glob
import json
import os
import shutil
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymill.plans import analysis_job, benchmark_counts, prepare_job  # noqa: E402
from tallymill.sinks import write_csv  # noqa: E402
from tallymill.workloads import QUERIES  # noqa: E402
from tallymill.workloads.standin import cleaned_incidents, raw_incidents, table  # noqa: E402

# Fixed value: rows of the published runs.
PUBLISHED_ROWS = 7_728_394
HEADLINES = [
    "state_summary",
    "top_cities",
    "year_month_summary",
    "weather_condition_summary",
    "road_feature_summary",
    "numeric_weather_overall",
    "grouping_sets_counts",
    "incident_rollup",
    "quality_summary",
    "dedup_keep_first",
    "parse_timestamps",
    "event_weekday_hour",
    "city_severity_min",
    "weekday_hour_summary",
    "missing_values",
    "clean_rows",
    "reconciliation",
    "benchmark_runs",
    "chart_features",
    "parse_timestamps_mixed",
    "incremental_counts",
    "dedup_increment",
    "csv_quarantine",
    "content_checks",
    "quantiles_by_state",
    "largest_groups",
    "distinct_sketches_by_year",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def run_out(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallymill-bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="run-bench-")
    raw = f"{root}/raw_csv"
    raw_incidents(spark, sf_dir).write.option("header", True).csv(raw)
    rows = table(spark, sf_dir, "lineitem").count()

    timings: dict[str, float] = {}
    copies = max(1, round(PUBLISHED_ROWS / rows))
    raws = [raw, *[shutil.copytree(raw, f"{raw}_{i}") for i in range(1, copies)]]
    out = iter(f"{root}/counts_{i}" for i in range(99))
    count = lambda source: write_csv(benchmark_counts(spark, source), next(out))
    counts = [seconds(lambda: count(raw)) for _ in range(4)]
    timings["csv_grouping_counts"] = round(statistics.median(counts[1:]), 4)
    scaled = min(seconds(lambda: count(raws)) for _ in range(2))
    timings["csv_grouping_counts_published_scale"] = scaled
    stored = f"{root}/out/processed/accidents_parquet"
    timings["prepare_job"] = min(seconds(lambda: prepare_job(spark, raw, f"{root}/out")) for _ in range(2))
    timings["analysis_job"] = min(seconds(lambda: analysis_job(spark, stored, f"{root}/reports")) for _ in range(2))
    timings["prepare_job_published_scale"] = seconds(lambda: prepare_job(spark, raws, f"{root}/large"))
    kept = spark.read.parquet(stored).count()
    # the copies' IDs repeat, so the large cleaned table is the stored one several times over
    several = max(1, round(PUBLISHED_ROWS / max(1, kept)))
    store = f"{root}/stored"
    for path in glob.glob(f"{stored}/Year=*/*.parquet"):
        year, name = path.split(os.sep)[-2:]
        os.makedirs(f"{store}/{year}", exist_ok=True)
        for i in range(several):
            shutil.copy(path, f"{store}/{year}/{i}-{name}")
    timings["analysis_job_published_scale"] = seconds(lambda: analysis_job(spark, store, f"{root}/large_reports"))
    # Reports are made from records stored once, as the jobs do; the storing has a row of its own.
    timings["cleaned_records"] = min(seconds(lambda: cleaned_incidents(spark, sf_dir)) for _ in range(2))
    cleaned = cleaned_incidents(spark, sf_dir)
    for name in HEADLINES:
        query = QUERIES[name]
        run = (lambda: query.over(cleaned)) if hasattr(query, "over") else (lambda: query(spark, sf_dir))
        timings[name] = min(seconds(lambda: run_out(run())) for _ in range(2))

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries and jobs",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": rows,
                "csv_rows_per_sec": round(rows / timings["csv_grouping_counts"]),
                "published_scale_rows": rows * copies,
                "published_scale_rows_per_sec": round(rows * copies / scaled),
                "prepare_rows_per_sec": round(rows * copies / timings["prepare_job_published_scale"]),
                "analysis_rows_per_sec": round(kept * several / timings["analysis_job_published_scale"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
