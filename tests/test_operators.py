"""Operators on inline rows, against values worked out by hand or brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tallymill.operators import (
    apply_rules,
    clean,
    combination_counts,
    dedup_by_key,
    derive,
    dimension_check,
    dimension_counts,
    dimension_table,
    distinct_metrics,
    five_way_check,
    flag_counts,
    flag_summary,
    flag_summary_union,
    flag_summary_unpivot,
    grouping_counts,
    grouping_counts_sql,
    having_min,
    level_counts,
    mean_columns,
    missing_values,
    profile,
    quality_summary,
    reconcile,
    run_metrics,
    run_summary,
    run_table,
    side_by_side,
    summarize,
    top_ascending,
    top_k,
    validation,
)
from tallymill.plans import charts, reports


def rows(frame):
    return [tuple(r) for r in frame.collect()]


# --- rows -----------------------------------------------------------------


def test_dedup_matches_brute_force_with_a_hot_key(spark):
    """A third of all rows share one key, and nulls sit in the order columns."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(900)}"
        data.append((key, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), i % 50))
    kept = dedup_by_key(spark.createDataFrame(data, "k string, a int, b string, c int").repartition(7), ["k"])
    nulls_last = lambda t: tuple((v is None, v) for v in t[1:])
    want = {}
    for row in data:
        if row[0] not in want or nulls_last(row) < nulls_last(want[row[0]]):
            want[row[0]] = row
    assert sorted(rows(kept)) == sorted(want.values())


def test_dedup_with_given_order_and_null_key(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 9), ("a", 1), ("b", 2)], "k string, v int")
    assert set(rows(dedup_by_key(frame, ["k"], [F.desc("v")]))) == {(None, 2), ("a", 9), ("b", 2)}


RECORD = "ID string, Severity int, Start_Time timestamp_ntz, City string, State string"
NOON = dt.datetime(2020, 5, 4, 12)


def test_dedup_comes_before_the_rules(spark):
    """The kept copy of ``a`` (first by severity) breaks a rule, so ``a`` is gone."""
    data = [
        (None, 1, NOON, "X", "CA"),
        ("a", 0, NOON, "X", "CA"),
        ("a", 2, NOON, "X", "CA"),
        ("b", 2, NOON, None, "CA"),
        ("c", 2, NOON, "X", None),
        ("d", None, NOON, "X", "CA"),
        ("e", 3, None, "X", "CA"),
        ("f", 3, NOON, "X", "TX"),
    ]
    kept = clean(spark.createDataFrame(data, RECORD)).orderBy("ID")
    got = [(r.ID, r.City_State, r.Year, r.Month, r.Weekday, r.Weekday_Number, r.Hour, r.Severity_3_4) for r in kept.collect()]
    assert got == [
        ("b", "Unknown, CA", 2020, 5, "Monday", 2, 12, 0),
        ("f", "X, TX", 2020, 5, "Monday", 2, 12, 1),
    ]


def test_rules_and_derive_take_other_names(spark):
    frame = spark.createDataFrame([("u", 7, NOON), ("v", 1, NOON), (None, 9, NOON)], "who string, lvl int, at timestamp_ntz")
    kept = apply_rules(frame, not_null=["at"], between={"lvl": (5, 9)}, fill={"who": "?"})
    out = derive(kept, time="at", place=["who"], place_name="label", level="lvl", threshold=8, flag_name="high")
    assert sorted((r.label, r.high) for r in out.collect()) == [("?", 1), ("u", 0)]


# --- quality --------------------------------------------------------------


def test_profile_keeps_three_valued_logic(spark):
    data = [("a", 1, NOON), ("b", 5, None), (None, None, NOON), ("a", 0, NOON)]
    frame = spark.createDataFrame(data, "ID string, Severity int, Start_Time timestamp_ntz")
    figures = profile(frame)
    row = figures.first()
    assert (row.row_count, row.distinct_id_count, row.null_id_count) == (4, 2, 1)
    assert row.invalid_severity_count == 2
    assert rows(missing_values(figures)) == [("ID", 1, 25.0), ("Severity", 1, 25.0), ("Start_Time", 1, 25.0)]
    summary = dict(rows(quality_summary(figures, input_uri="in")))
    assert list(summary) == [
        "input_uri",
        "row_count",
        "column_count",
        "distinct_id_count",
        "duplicate_or_null_id_difference",
        "null_id_count",
        "invalid_severity_count",
        "minimum_start_time",
        "maximum_start_time",
    ]
    assert summary["duplicate_or_null_id_difference"] == "2"
    assert summary["minimum_start_time"] == str(NOON)
    assert profile(frame, approx=True).first().distinct_id_count == 2


def test_profile_of_nothing(spark):
    figures = profile(spark.createDataFrame([], "ID string, Severity int, Start_Time timestamp_ntz"))
    summary = dict(rows(quality_summary(figures, input_uri="in")))
    assert summary["row_count"] == summary["null_id_count"] == summary["invalid_severity_count"] == "0"
    assert summary["minimum_start_time"] == "None"
    assert {r[1:] for r in rows(missing_values(figures))} == {(0, None)}


def test_validation(spark):
    figures = profile(spark.createDataFrame([("a", 1, NOON)] * 3, "ID string, Severity int, Start_Time timestamp_ntz"))
    good = dict(rows(validation(figures, spark.range(1), processed_uri="p")))
    assert good == {"cleaned_row_count": "1", "rows_removed": "2", "processed_uri": "p", "status": "PASS"}
    assert dict(rows(validation(figures, spark.range(2), processed_uri="p")))["status"] == "FAIL"


def test_distinct_metrics(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1)], "a int, b int")
    assert rows(distinct_metrics(frame, ["a", "b"])) == [(4, 2, 2)]


# --- summaries ------------------------------------------------------------

GOLDEN = [(1, 67366, 0.8717), (2, 6156981, 79.667), (3, 1299337, 16.8125), (4, 204710, 2.6488)]


def test_golden_shares(spark):
    counts = spark.createDataFrame([g[:2] for g in GOLDEN], "Severity int, Accident_Count bigint")
    assert rows(reports.severity_distribution(counts)) == GOLDEN


def test_weights_give_what_rows_give(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.choice([None, 1, 2, 3, 4])) for _ in range(500)]
    frame = spark.createDataFrame(data, "k string, Severity int")
    options = dict(mean=reports.severity_mean(), rate=reports.severe_rate(), share="share", order=["k"])
    direct = summarize(frame, ["k"], **options)
    counted = summarize(level_counts(frame, ["k"]), ["k"], weight="Accident_Count", **options)
    assert rows(direct) == rows(counted)
    assert abs(sum(r.share for r in direct.collect()) - 100) < 0.001


def test_round_is_half_up(spark):
    frame = spark.createDataFrame([("a", 0.00005), ("b", 0.00015), ("c", None)], "k string, v double")
    got = rows(summarize(frame, ["k"], mean={"m": "v"}, order=["k"]))
    assert got == [("a", 1, 0.0001), ("b", 1, 0.0002), ("c", 1, None)]


def test_total_can_be_given(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    total = spark.range(1).select(F.lit(8))
    assert rows(summarize(frame, ["k"], share="s", total=total, order=["k"])) == [("a", 2, 25.0), ("b", 1, 12.5)]


def test_rankings_break_ties_by_label(spark):
    data = [("Salem, OR", 9706), ("Rochester, NY", 9706), ("Big, TX", 10000), ("Small, CA", 1)]
    frame = spark.createDataFrame(data, "City_State string, Accident_Count bigint")
    top = top_k(frame, 3, reports.by_count("City_State"))
    assert [r[0] for r in rows(top)] == ["Big, TX", "Rochester, NY", "Salem, OR"]
    assert [r[0] for r in rows(top_ascending(frame, "City_State", n=2))] == ["Rochester, NY", "Big, TX"]
    assert having_min(frame, 9706).count() == 3


def test_city_severity_order(spark):
    data = [("A", "CA", 2, 10), ("B", "CA", 2, 10), ("C", "CA", 2, 20), ("D", "CA", 3, 10), ("E", "CA", 4, 9)]
    counts = spark.createDataFrame(data, "City string, State string, Severity int, Accident_Count bigint")
    assert [r.City for r in reports.city_severity(counts, 10).collect()] == ["D", "C", "A", "B"]


def test_means_ignore_nulls(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, None), (None, None)], "`Temperature(F)` double, `Humidity(%)` double")
    out = mean_columns(frame, frame.columns)
    assert out.columns == ["Mean_Temperature_F", "Mean_Humidity_pct"] and rows(out) == [(1.5, None)]


DIMENSIONS = ["State", "Year", "Severity"]


def counted_frame(spark):
    data = [("CA", 2016, 2), ("CA", 2017, 2), ("TX", 2016, 3), (None, 2016, 2), ("TX", None, 9)]
    return spark.createDataFrame(data, "State string, Year int, Severity int")


def test_grouping_counts_forms_agree(spark):
    frame = counted_frame(spark).filter("State IS NOT NULL AND Year IS NOT NULL")
    api = sorted(rows(grouping_counts(frame, DIMENSIONS)))
    assert api == sorted(rows(grouping_counts_sql(frame, DIMENSIONS, view="v_counts")))
    assert api == [
        ("Severity", "2", 2),
        ("Severity", "3", 1),
        ("State", "CA", 2),
        ("State", "TX", 1),
        ("Year", "2016", 2),
        ("Year", "2017", 1),
    ]


def test_condition_counts_equal_filtered_counts(spark):
    frame = counted_frame(spark)
    valid = F.col("State").isNotNull() & F.col("Year").isNotNull()
    a = sorted(rows(grouping_counts(frame, DIMENSIONS, where=valid)))
    assert a == sorted(rows(grouping_counts(frame.filter(valid), DIMENSIONS)))
    seen = combination_counts(frame, DIMENSIONS, where=valid).agg(F.sum("Input_Count"), F.sum("Accident_Count"))
    assert rows(seen) == [(5, 3)]


def test_dimension_tables(spark):
    counts = grouping_counts(counted_frame(spark).filter("State IS NOT NULL AND Year IS NOT NULL"), DIMENSIONS)
    assert rows(dimension_table(counts, "State", by_count=True)) == [("CA", 2), ("TX", 1)]
    year = dimension_table(counts, "Year", kind="int")
    assert year.dtypes[0] == ("Year", "int") and rows(year) == [(2016, 2), (2017, 1)]


# --- flags ----------------------------------------------------------------


def test_flag_forms_agree_and_absent_values_have_no_row(spark):
    rng = random.Random(5)
    data = [(rng.randint(1, 4), rng.choice([True, False, None]), rng.choice([True, False]), False) for _ in range(400)]
    frame = spark.createDataFrame(data, "Severity int, Bump boolean, Stop boolean, Turning_Loop boolean")
    flags = ["Bump", "Stop", "Turning_Loop"]
    measures = dict(mean=reports.severity_mean(), rate=reports.severe_rate())
    packed = rows(flag_summary(flag_counts(frame, flags), flags, **measures))
    assert packed == rows(flag_summary_unpivot(frame, flags, **measures))
    assert packed == rows(flag_summary_union(frame, flags, **measures))
    assert [r[:2] for r in packed] == [
        ("Bump", True),
        ("Bump", False),
        ("Stop", True),
        ("Stop", False),
        ("Turning_Loop", False),
    ]
    assert packed[-1][2] == 400


# --- checks and runs ------------------------------------------------------


def test_reconcile_really_compares(spark):
    good = spark.createDataFrame([("a", 2), ("b", 3)], "k string, Accident_Count bigint")
    bad = good.filter("k = 'a'")
    total = spark.range(1).select(F.lit(5).cast("bigint"))
    got = rows(reconcile(total, {"state": good, "year": bad, "none": good.filter("false")}, info={"input_uri": "x"}))
    assert got == [
        ("input_row_count", "5", "PASS"),
        ("state_count_sum", "5", "PASS"),
        ("year_count_sum", "2", "FAIL"),
        ("none_count_sum", "0", "FAIL"),
        ("input_uri", "x", "INFO"),
    ]


def test_dimension_check_reports_absent_dimensions(spark):
    counts = spark.createDataFrame([("State", "CA", 3), ("Year", "2016", 2)], "Dimension string, Value string, Accident_Count bigint")
    expected = spark.range(1).select(F.lit(3).cast("bigint"))
    assert rows(dimension_check(counts, expected, DIMENSIONS)) == [
        ("State", 3, 3, "PASS"),
        ("Year", 2, 3, "FAIL"),
        ("Severity", 0, 3, "FAIL"),
    ]


def test_five_way(spark):
    frame = counted_frame(spark)
    valid = F.col("State").isNotNull() & F.col("Year").isNotNull()
    counts = grouping_counts(frame, DIMENSIONS, where=valid)
    assert [r[2] for r in rows(five_way_check(frame, valid, counts))] == ["PASS"] + ["FAIL"] * 4
    kept = frame.filter(valid)
    goal = spark.range(1).select(F.lit(3))
    assert {r[2] for r in rows(five_way_check(kept, valid, counts, goal))} == {"PASS"}


SPARK_SECONDS = [22.4094, 15.4447, 14.9614]
PANDAS_SECONDS = [15.9206, 15.632, 15.4213]


def run_inputs(spark, seconds, expected=3):
    log = spark.createDataFrame(
        [(i + 1, s, expected, f"run_{i + 1}") for i, s in enumerate(seconds)],
        "run int, total_seconds double, expected_rows bigint, output_uri string",
    )
    counts = [(i + 1, d, "x", 3) for i in range(len(seconds)) for d in DIMENSIONS]
    return spark.createDataFrame(counts, "run int, Dimension string, Value string, Accident_Count bigint"), log


def test_run_table_and_summary(spark):
    table = run_table(*run_inputs(spark, SPARK_SECONDS))
    assert rows(table)[0] == (1, 22.4094, 3, 3, 3, "PASS", "run_1")
    summary = rows(run_summary(table, before={"framework": "PySpark", "used": ["a", "b"]}, after={"timed": False}))
    assert summary == [
        ("framework", "PySpark"),
        ("used", '["a","b"]'),
        ("runs", "3"),
        ("median_total_seconds", "15.4447"),
        ("all_runs_reconciled", "true"),
        ("timed", "false"),
    ]
    failing = run_table(*run_inputs(spark, SPARK_SECONDS, expected=4))
    assert {r.reconciliation_status for r in failing.collect()} == {"FAIL"}
    assert dict(rows(run_summary(failing)))["all_runs_reconciled"] == "false"


def test_run_without_counts_fails(spark):
    counts, log = run_inputs(spark, SPARK_SECONDS)
    table = run_table(counts.filter("run <> 2"), log)
    assert [r.reconciliation_status for r in table.collect()] == ["PASS", "FAIL", "PASS"]


def test_run_metrics(spark):
    counts, log = run_inputs(spark, [1.0])
    log = log.select(
        "run", "expected_rows", F.lit(3).alias("input_rows"), F.lit(3).alias("valid_rows"),
        F.lit(15.9099).alias("scan_and_aggregate_seconds"), F.lit(0.0107).alias("write_seconds"),
    )
    assert rows(run_metrics(counts, log)) == [(1, 3, 3, 15.9099, 0.0107, 15.9206, "PASS")]


def test_side_by_side(spark):
    left = run_table(*run_inputs(spark, PANDAS_SECONDS))
    right = run_table(*run_inputs(spark, SPARK_SECONDS[:2]))
    assert rows(side_by_side(left, right)) == [(1, 15.9206, 22.4094), (2, 15.632, 15.4447)]
    labels = rows(charts.runtimes(left, right, ("Pandas", "PySpark")).select("Pandas_Label", "PySpark_Label"))
    assert labels == [("15.92", "22.41"), ("15.63", "15.44")]


# --- chart tables ---------------------------------------------------------


def test_chart_tables(spark):
    years = spark.createDataFrame([(2016, 410821), (2017, 718093)], "Year int, Accident_Count bigint")
    assert rows(charts.yearly(years)) == [(2016, 410821, True, "0.41M"), (2017, 718093, False, "0.72M")]
    severity = spark.createDataFrame([(g[0], g[2]) for g in GOLDEN], "Severity int, Percentage_of_All_Records double")
    shares = rows(charts.severity_shares(severity))
    assert shares[1][:3] == (2, 79.667, "79.67%") and shares[1][3] == 79.667 * 1.18
    weather = spark.createDataFrame([("Fair", 9), ("Missing", 50), ("Rain", 3)], "Weather_Condition_Group string, Accident_Count bigint")
    assert rows(charts.top_weather(weather)) == [("Rain", 3, "3"), ("Fair", 9, "9")]
    road = spark.createDataFrame(
        [("Give_Way", True, 36582), ("Bump", True, 3514), ("Bump", False, 9), ("Turning_Loop", True, 1)],
        "Feature string, Feature_Present boolean, Accident_Count bigint",
    )
    assert rows(charts.present_features(road)) == [("Bump", 3514, "3,514"), ("Give Way", 36582, "36,582")]


def test_dimension_counts_with_extra_keys(spark):
    counted = combination_counts(counted_frame(spark).withColumn("run", F.lit(1)), ["run", *DIMENSIONS])
    out = dimension_counts(counted, DIMENSIONS, extra_keys=["run"])
    assert out.columns == ["run", "Dimension", "Value", "Accident_Count"]
    assert out.filter("Dimension = 'Severity'").agg(F.sum("Accident_Count")).first()[0] == 5
