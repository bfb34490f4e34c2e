"""End-to-end jobs: prepare, analyse, benchmark.

All run on the caller's session and leave it open.  Intermediate tables go below
the given output root, which every executor can reach, so a lost executor costs
tasks and not the job.  They are removed when the job ends, well or not, unless
``keep_staging`` is set.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import parse_timestamp
from ..operators.checks import compare_contents
from ..operators.increments import FILE, PartialCounts
from ..operators.quality import missing_values, profile, quality_summary, validation
from ..operators.rows import ROW, clean, numbered, retype_times, row_rule
from ..operators.runs import run_facts, run_metrics, run_summary, run_table, timed
from ..operators.summaries import (
    combination_counts,
    dimension_counts,
    dimension_table,
)
from ..sinks.writers import read_slices, remove, rewrite_partitions, staged, write_csv, write_json, write_partitioned
from ..sources.files import stored_figures
from ..sources.readers import read_incidents_csv, read_parquet, read_summary_csv
from ..sources.schema import COUNT_COLUMNS
from . import reports
from .rollup import base_counts, incident_rollup, report_base, rollup_slice

# Fixed values here and below: output folders, report names and metric keys are those
# that readers of the outputs look for.
DIMENSIONS = ("State", "Year", "Severity")


def uri_text(uri: str | list[str]) -> str:
    """How an input of one or several paths reads in a table."""
    return uri if isinstance(uri, str) else ",".join(uri)


@contextmanager
def staging(spark: SparkSession, root: str, keep: bool) -> Iterator[str]:
    """A folder for tables that only the job itself reads, under a name that nothing else has."""
    folder = f"{root}/staging-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        if not keep:
            remove(spark, folder)


def prepare_job(
    spark: SparkSession,
    input_uri: str,
    output_root: str,
    *,
    stage: bool = True,
    zoned: bool = False,
    rebalance: bool = True,
    keep_staging: bool = False,
    max_records_per_file: int | None = None,
    checksums: bool = False,
    **csv_options,
) -> DataFrame:
    """Raw CSV to quality tables, the cleaned Year-partitioned dataset and its validation.

    The typed rows are stored as Parquet first, so the text is parsed once and the
    profile's passes read only the columns they need; the cleaning finds the rows it keeps by their numbers
    there (``dedup_stored``).  ``stage=False`` saves that
    copy, scans the CSV for each pass and exchanges whole rows.  Profile and cleaning do not depend on each
    other and run side by side.  ``zoned=True`` stores ``timestamp`` in the session zone
    instead of clock times.  ``checksums=True`` compares the stored rows' hashes with those of the cleaned rows, which
    are made once more for it, and writes ``content_check``.  Returns the stored cleaned dataset.
    """
    with staging(spark, output_root, keep_staging) as folder:
        typed = retype_times(read_incidents_csv(spark, input_uri, **csv_options), zoned=zoned)
        wide = None
        if stage:
            typed = staged(numbered(typed), f"{folder}/typed", "zstd", sliced=True).drop(ROW)
            wide = read_slices(spark, f"{folder}/typed")
        stored = _prepare(typed, wide, folder, input_uri, output_root, rebalance, max_records_per_file)
        if checksums:
            write_csv(compare_contents(clean(typed), stored), f"{output_root}/results/data_quality/content_check")
        return stored


def refresh_years(
    spark: SparkSession,
    input_uri: str,
    output_root: str,
    years: Sequence[int],
    *,
    zoned: bool = False,
    keep_staging: bool = False,
    **csv_options,
) -> DataFrame:
    """Make some years of the cleaned dataset anew from raw CSV; the files of other years stay.

    All raw rows are read, since an ID's first row may lie in any year.  Returns the stored dataset.
    """
    processed = f"{output_root}/processed/accidents_parquet"
    with staging(spark, output_root, keep_staging) as folder:
        typed = retype_times(read_incidents_csv(spark, input_uri, **csv_options), zoned=zoned)
        rewrite_partitions(clean(typed), processed, years, folder)
    return read_parquet(spark, processed)


def _prepare(
    typed: DataFrame,
    wide: DataFrame | None,
    folder: str,
    input_uri: str,
    output_root: str,
    rebalance: bool,
    max_records_per_file: int | None,
) -> DataFrame:
    spark = typed.sparkSession
    quality = f"{output_root}/results/data_quality"
    processed = f"{output_root}/processed/accidents_parquet"

    def write_quality() -> DataFrame:
        figures = staged(profile(typed), f"{folder}/profile")
        write_csv(quality_summary(figures, input_uri=uri_text(input_uri)), f"{quality}/summary")
        write_csv(
            missing_values(figures),
            f"{quality}/missing_values",
            order=[F.desc("missing_percentage"), "column"],
        )
        return figures

    with ThreadPoolExecutor(1) as pool:
        figures = pool.submit(write_quality)
        write_partitioned(
            clean(typed) if wide is None else clean(wide, folder=folder),
            processed,
            by=["Year"],
            rebalance=rebalance,
            max_records_per_file=max_records_per_file,
        )
        stored = read_parquet(spark, processed)
        kept = stored_figures(spark, processed)["row_count"]  # from the footers
        check = validation(figures.result(), kept, processed_uri=processed)
    write_csv(check, f"{quality}/validation")
    return stored


def analysis_reports(
    cleaned: DataFrame,
    counts: Callable[[str], DataFrame],
    *,
    minimum_city_count: int = 1000,
    total: DataFrame | None = None,
    info: dict[str, str] | None = None,
) -> dict[str, tuple[DataFrame, list]]:
    """All reports by name, each with its file order; ``counts`` gives a slice's counts."""
    place, times, weather = counts("place"), counts("time"), counts("weather")
    total = cleaned.agg(F.count("*")) if total is None else total
    state = reports.state_summary(place, total)
    year = reports.year_summary(times)
    severity = reports.severity_distribution(weather, total)
    return {
        "state_summary": (state, reports.by_count("State")),
        "top_100_cities_by_count": (reports.top_cities(place), reports.by_count("City_State")),
        f"city_severity_min_{minimum_city_count}": (
            reports.city_severity(place, minimum_city_count),
            reports.by_mean("City_State"),
        ),
        "year_summary": (year, ["Year"]),
        "year_month_summary": (reports.year_month_summary(times), ["Year", "Month"]),
        "weekday_summary": (reports.weekday_summary(times, total), ["Weekday_Number"]),
        "hour_summary": (reports.hour_summary(times, total), ["Hour"]),
        "weekday_hour_summary": (
            reports.weekday_hour_summary(times),
            ["Weekday_Number", "Hour"],
        ),
        "severity_distribution": (severity, ["Severity"]),
        "weather_condition_summary": (
            reports.weather_summary(weather, total),
            reports.by_count("Weather_Condition_Group"),
        ),
        "numeric_weather_overall": (reports.numeric_weather(cleaned), []),
        "road_feature_summary": (
            reports.road_feature_summary(counts("feature")),
            ["Feature", F.desc("Feature_Present")],
        ),
        "reconciliation": (
            reports.reconciliation(total, state=state, year=year, severity=severity, info=info),
            [],
        ),
    }


def analysis_job(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    *,
    minimum_city_count: int = 1000,
    one_scan: bool = True,
    writers: int = 8,
    keep_staging: bool = False,
) -> None:
    """The cleaned dataset to all reports, one CSV folder each.

    ``one_scan`` counts every key in a single pass, stores those few rows, and makes
    the reports from them; only the numeric means read the dataset again.  Without
    it the used columns are cached, in one pass before any report starts, and each report
    aggregates them itself.  The reports do not depend on one another, so ``writers`` of them are in flight at a time.
    """
    cleaned = read_parquet(spark, input_uri)
    base = report_base(cleaned)
    with staging(spark, output_uri, keep_staging) as folder:
        if one_scan:
            counts = partial(rollup_slice, staged(incident_rollup(base), f"{folder}/rollup"))
            _write_reports(cleaned, counts, folder, input_uri, output_uri, minimum_city_count, writers)
            return
        base = base.persist()
        try:
            base.count()
            counts = partial(base_counts, base)
            _write_reports(cleaned, counts, folder, input_uri, output_uri, minimum_city_count, writers)
        finally:
            base.unpersist()


def _write_reports(
    cleaned: DataFrame,
    counts: Callable[[str], DataFrame],
    folder: str,
    input_uri: str,
    output_uri: str,
    minimum_city_count: int,
    writers: int,
) -> None:
    total = staged(cleaned.agg(F.count("*")), f"{folder}/total")
    outputs = analysis_reports(
        cleaned,
        counts,
        minimum_city_count=minimum_city_count,
        total=total,
        info={"input_uri": uri_text(input_uri), "output_uri": output_uri},
    )
    with ThreadPoolExecutor(writers) as pool:
        writes = [
            pool.submit(write_csv, frame, f"{output_uri}/{name}", order=order)
            for name, (frame, order) in outputs.items()
        ]
        for write in writes:
            write.result()


def benchmark_source(spark: SparkSession, input_uri: str, **csv_options) -> DataFrame:
    """The three benchmark columns of the raw CSV, time parsed, plus Year."""
    source = read_incidents_csv(spark, input_uri, columns=COUNT_COLUMNS, **csv_options)
    parsed = source.withColumn("Start_Time", parse_timestamp("Start_Time"))
    return parsed.withColumn("Year", F.year("Start_Time"))


def benchmark_rule():
    """A row that counts: place, level and time all usable."""
    return row_rule(["State", "Start_Time"], {"Severity": (1, 4)})


def benchmark_combinations(spark: SparkSession, input_uri: str, **csv_options) -> DataFrame:
    """Input and valid rows per combination of the benchmark dimensions, from one scan."""
    source = benchmark_source(spark, input_uri, **csv_options)
    return combination_counts(source, DIMENSIONS, where=benchmark_rule())


def benchmark_counts(spark: SparkSession, input_uri: str, **csv_options) -> DataFrame:
    """State, year and severity counts of the valid rows of a raw CSV."""
    return dimension_counts(benchmark_combinations(spark, input_uri, **csv_options), DIMENSIONS)


def benchmark_store(spark: SparkSession, store_uri: str, **csv_options) -> PartialCounts:
    """Counts of the benchmark dimensions kept per input file below ``store_uri``."""

    def count(files: list[str]) -> DataFrame:
        source = benchmark_source(spark, files, file_column=FILE, **csv_options)
        return combination_counts(source, [FILE, *DIMENSIONS], where=benchmark_rule())

    return PartialCounts(spark, store_uri, DIMENSIONS, ["Input_Count", "Accident_Count"], count)


def benchmark_increment(
    spark: SparkSession, input_uri: str | list[str], store_uri: str, **csv_options
) -> DataFrame:
    """``benchmark_counts`` of all files counted so far, after reading those that are new or have changed."""
    store = benchmark_store(spark, store_uri, **csv_options)
    store.add(input_uri)
    return dimension_counts(store.merged(), DIMENSIONS)


def benchmark_job(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    *,
    runs: int = 3,
    expected_rows: int | None = None,
    keep_staging: bool = False,
    **csv_options,
) -> DataFrame:
    """Time the counts ``runs`` times, reconcile each run, store run table and summary.

    One timed run reads, validates, counts and writes.  Each run stores its counted
    combinations, which hold the input rows too, so ``expected_rows``, when it is not given, is
    the first run's and costs no further scan.  Returns the stored run table.
    """
    with staging(spark, output_uri, keep_staging) as folder:
        return _benchmark(spark, input_uri, output_uri, folder, runs, expected_rows, csv_options)


def _benchmark(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    folder: str,
    runs: int,
    expected_rows: int | None,
    csv_options: dict,
) -> DataFrame:
    measured, stored, combinations = [], [], []
    for number in range(1, runs + 1):
        uri = f"{output_uri}/run_{number}/counts"

        def run() -> None:
            counted = benchmark_combinations(spark, input_uri, **csv_options)
            combinations.append(staged(counted, f"{folder}/combinations_{number}"))
            write_csv(dimension_counts(combinations[-1], DIMENSIONS), uri)

        measured.append((number, timed(run), uri))
        saved = read_summary_csv(spark, uri, layout="dimension_counts")
        stored.append(saved.withColumn("run", F.lit(number)))

    log = spark.createDataFrame(measured, "run int, total_seconds double, output_uri string")
    if expected_rows is None:
        goal = F.coalesce(combinations[0].agg(F.sum("Input_Count")).scalar(), F.lit(0))
    else:
        goal = F.lit(expected_rows)
    log = log.withColumn("expected_rows", goal)
    counts = reduce(DataFrame.unionByName, stored)

    table_uri = f"{output_uri}/benchmark_runs"
    write_csv(run_table(counts, log), table_uri, order=["run"])
    table = read_summary_csv(spark, table_uri, layout="run_table")
    facts = {
        "framework": "PySpark",
        "spark_version": spark.version,
        "spark_master": spark.sparkContext.master,
        "default_parallelism": spark.sparkContext.defaultParallelism,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
        "input_uri": uri_text(input_uri),
    }
    scope = {
        "timing_scope": "CSV scan, row rules, counts of three dimensions, CSV write",
        "cluster_provisioning_time_included": False,
    }
    write_csv(run_summary(table, before=facts, after=scope), f"{output_uri}/benchmark_summary")
    return table


def split_benchmark_job(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    *,
    runs: int = 3,
    expected_rows: int | None = None,
    keep_staging: bool = False,
    **csv_options,
) -> DataFrame:
    """The same counts as three tables per run, with scan and write timed apart.

    Each run also records input and valid rows and writes its metrics as JSON; the
    experiment summary is JSON too.  Returns the stored run table.
    """
    with staging(spark, output_uri, keep_staging) as stage:
        return _split_benchmark(spark, input_uri, output_uri, stage, runs, expected_rows, csv_options)


def _split_benchmark(
    spark: SparkSession,
    input_uri: str,
    output_uri: str,
    stage: str,
    runs: int,
    expected_rows: int | None,
    csv_options: dict,
) -> DataFrame:
    frames = []
    for number in range(1, runs + 1):
        folder = f"{output_uri}/run_{number}"
        held = []

        def count() -> None:
            held.append(staged(benchmark_combinations(spark, input_uri, **csv_options), f"{stage}/combinations_{number}"))

        scan = timed(count)
        counted = held[0]
        counts = dimension_counts(counted, DIMENSIONS)
        kinds = {"State": "string", "Year": "int", "Severity": "int"}

        def write_tables() -> None:
            for dimension, kind in kinds.items():
                table = dimension_table(counts, dimension, kind=kind)
                order = [F.desc("Accident_Count"), "State"] if dimension == "State" else [dimension]
                write_csv(table, f"{folder}/{dimension.lower()}_counts", order=order)

        write = timed(write_tables)
        seen = counted.agg(
            F.sum("Input_Count").alias("input_rows"), F.sum("Accident_Count").alias("valid_rows")
        )
        goal = F.lit(expected_rows) if expected_rows is not None else F.col("input_rows")
        log = seen.select(
            F.lit(number).alias("run"),
            "input_rows",
            "valid_rows",
            F.lit(scan).alias("scan_and_aggregate_seconds"),
            F.lit(write).alias("write_seconds"),
            goal.alias("expected_rows"),
        )
        metrics = run_metrics(counts.withColumn("run", F.lit(number)), log)
        frames.append(staged(metrics, f"{stage}/run_metrics_{number}"))
        write_json(frames[-1], f"{folder}/run_metrics_json")
    table = reduce(DataFrame.unionByName, frames)
    write_csv(table, f"{output_uri}/benchmark_runs", order=["run"])
    summary = run_facts(
        table,
        before={"framework": "PySpark", "input": uri_text(input_uri), "columns_used": COUNT_COLUMNS},
        seconds=("scan_and_aggregate_seconds", "total_seconds"),
    )
    write_json(summary, f"{output_uri}/benchmark_summary")
    return read_summary_csv(spark, f"{output_uri}/benchmark_runs", layout="split_run_table")

