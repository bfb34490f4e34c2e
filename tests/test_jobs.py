"""The jobs end to end, from a raw CSV of the stand-in records."""

import pytest
from pyspark.sql import functions as F

from tallymill.plans import analysis_job, benchmark_job, prepare_job, split_benchmark_job
from tallymill.sources import TIME_COLUMNS, read_summary_csv
from tallymill.workloads.standin import raw_incidents


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("jobs"))


@pytest.fixture(scope="module")
def raw(spark, sf_dir, root):
    path = f"{root}/raw"
    raw_incidents(spark, sf_dir).write.option("header", True).csv(path)
    return path


@pytest.fixture(scope="module")
def stored(spark, raw, root):
    return prepare_job(spark, raw, f"{root}/out")


def pairs(frame):
    return {r[0]: r[1] for r in frame.collect()}


def test_prepare(spark, stored, root, raw):
    assert len(stored.columns) == 53 and stored.columns[-1] == "Year"
    assert stored.count() == stored.select("ID").distinct().count()
    assert stored.filter("ID IS NULL OR State IS NULL OR Start_Time IS NULL").count() == 0
    quality = f"{root}/out/results/data_quality"
    summary = pairs(read_summary_csv(spark, f"{quality}/summary", layout="metrics"))
    assert summary["row_count"] == "6000" and summary["column_count"] == "46" and summary["input_uri"] == raw
    check = pairs(read_summary_csv(spark, f"{quality}/validation", layout="check STRING, value STRING"))
    assert check["status"] == "PASS"
    assert int(check["cleaned_row_count"]) + int(check["rows_removed"]) == 6000
    assert read_summary_csv(spark, f"{quality}/missing_values").count() == 46


def test_prepare_is_the_same_without_staging_and_on_repeat(spark, stored, root, raw):
    again = prepare_job(spark, raw, f"{root}/again", stage=False, rebalance=True)
    assert again.exceptAll(stored).count() == 0 and stored.exceptAll(again).count() == 0


def test_zoned_times_are_an_option(spark, stored, root, raw):
    zoned = prepare_job(spark, raw, f"{root}/zoned", zoned=True)
    assert dict(stored.dtypes)["Start_Time"] == "timestamp_ntz"
    assert dict(zoned.dtypes)["Start_Time"] == "timestamp"
    same = zoned.withColumns({n: F.col(n).cast("timestamp_ntz") for n in TIME_COLUMNS})
    assert same.exceptAll(stored).count() == 0 and same.count() == stored.count()


REPORTS = [
    "state_summary",
    "top_100_cities_by_count",
    "city_severity_min_20",
    "year_summary",
    "year_month_summary",
    "weekday_summary",
    "hour_summary",
    "weekday_hour_summary",
    "severity_distribution",
    "weather_condition_summary",
    "numeric_weather_overall",
    "road_feature_summary",
    "reconciliation",
]


def test_analysis_both_ways(spark, stored, root):
    source = f"{root}/out/processed/accidents_parquet"
    for one_scan, name in ((True, "one"), (False, "cached")):
        analysis_job(spark, source, f"{root}/{name}", minimum_city_count=20, one_scan=one_scan)
    rows = stored.count()
    for report in REPORTS:
        a = read_summary_csv(spark, f"{root}/one/{report}")
        b = read_summary_csv(spark, f"{root}/cached/{report}")
        if report == "reconciliation":
            a, b = a.filter("Status <> 'INFO'"), b.filter("Status <> 'INFO'")
            assert {(r.Value, r.Status) for r in a.collect()} == {(str(rows), "PASS")}
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        if "Percentage_of_All_Records" in a.columns:
            total = a.agg(F.sum("Accident_Count"), F.sum("Percentage_of_All_Records")).first()
            assert total[0] == rows and abs(total[1] - 100) < 0.01


def test_benchmark(spark, raw, root):
    table = benchmark_job(spark, raw, f"{root}/bench", runs=2)
    rows = table.orderBy("run").collect()
    assert [r.run for r in rows] == [1, 2]
    assert rows[0].state_total == rows[0].year_total == rows[0].severity_total
    assert {r.reconciliation_status for r in rows} == {"FAIL"}  # the raw rows hold invalid ones
    passing = benchmark_job(spark, raw, f"{root}/bench2", runs=1, expected_rows=rows[0].state_total)
    assert passing.first().reconciliation_status == "PASS"
    summary = pairs(read_summary_csv(spark, f"{root}/bench2/benchmark_summary", layout="metrics"))
    assert summary["runs"] == "1" and summary["all_runs_reconciled"] == "true"
    assert len(summary) == 11


def test_split_benchmark(spark, raw, root):
    row = split_benchmark_job(spark, raw, f"{root}/split", runs=1).first()
    assert row.input_rows == 6000 > row.valid_rows and row.reconciliation_status == "FAIL"
    state = read_summary_csv(spark, f"{root}/split/run_1/state_counts")
    assert state.agg(F.sum("Accident_Count")).first()[0] == row.valid_rows
    assert spark.read.json(f"{root}/split/run_1/run_metrics_json").first().valid_rows == row.valid_rows
    experiment = spark.read.json(f"{root}/split/benchmark_summary").first()
    assert experiment.runs == 1 and experiment.all_runs_reconciled is False
    assert experiment.median_total_seconds == row.total_seconds
    assert list(experiment.columns_used) == ["State", "Severity", "Start_Time"]
