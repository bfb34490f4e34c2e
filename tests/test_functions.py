"""Timestamps, labels and rounding on edge values."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans_helper import plan_of
from pyspark.sql import functions as F

from tallymill.functions import (
    fixed_point,
    millions_label,
    parse_timestamp,
    parse_timestamp_mixed,
    percent_label,
    readable,
    round_binary,
    safe_alias,
    thousands,
    time_parts,
    timestamp_text,
)
from tallymill.functions.timestamps import FRACTION, WHOLE_SECOND

# text, expected
TIMES = [
    ("2016-02-08 05:46:00", dt.datetime(2016, 2, 8, 5, 46)),
    ("2023-03-31 23:59:59.123456789", dt.datetime(2023, 3, 31, 23, 59, 59, 123456)),
    ("2020-01-01 00:00:00.000000000", dt.datetime(2020, 1, 1)),
    ("2019-06-01 10:00:00.123", dt.datetime(2019, 6, 1, 10, 0, 0, 123000)),
    ("2020-03-08 02:30:00", dt.datetime(2020, 3, 8, 2, 30)),
    ("2019-06-01", None),
    ("2019-06-01T10:00:00", None),
    ("2016-02-30 00:00:00", None),
    ("bad", None),
    ("", None),
    (None, None),
    (" 2016-02-08 05:46:00", None),
    ("2016-02-08 05:46:00.", None),
    ("2016-02-08 5:46:00", None),
    ("2016-02-08 05:46:00.1234567890", None),
    ("2016-02-08 05:46:00Z", None),
    ("2016-02-08 24:00:00", None),
]


def two_patterns(name):
    """The defining form of the parse."""
    return F.coalesce(
        F.try_to_timestamp(name, F.lit(FRACTION)), F.try_to_timestamp(name, F.lit(WHOLE_SECOND))
    )


def test_parse_timestamp(spark):
    frame = spark.createDataFrame([(t,) for t, _ in TIMES], "t string")
    got = [r[0] for r in frame.select(parse_timestamp("t")).collect()]
    assert got == [want for _, want in TIMES]
    assert frame.select(parse_timestamp("t").alias("x")).dtypes == [("x", "timestamp_ntz")]
    assert frame.select(parse_timestamp("t", zoned=True).alias("x")).dtypes == [("x", "timestamp")]


def test_parse_ignores_the_session_zone(spark):
    """02:30 on this day does not exist in New York; the recorded clock time still stands."""
    frame = spark.createDataFrame([("2020-03-08 02:30:00",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hour = frame.select(time_parts(parse_timestamp("t"))["Hour"]).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hour == 2


near_miss = st.builds(
    lambda y, m, d, h, n, s, sep, tail: f"{y:04d}-{m:02d}-{d:02d}{sep}{h:02d}:{n:02d}:{s:02d}{tail}",
    st.integers(0, 12000),
    st.integers(0, 13),
    st.integers(0, 32),
    st.integers(0, 25),
    st.integers(0, 61),
    st.integers(0, 61),
    st.sampled_from([" ", " ", " ", "T", "  ", ""]),
    st.sampled_from(
        ["", ".", ".1", ".123456789", ".1234567890", "Z", " ", ".12x", "+01:00"]
        + ["\n", "\r", "\r\n", "\u0085", "\u2028", ".5\n"]
    ),
)
signed = near_miss.map(lambda t: "+1" + t) | near_miss.map(lambda t: "-" + t)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(near_miss | signed | st.text(max_size=24), min_size=60, max_size=120))
def test_parse_equals_the_two_pattern_form(spark, texts):
    frame = spark.createDataFrame([(t.replace("\x00", ""),) for t in texts], "t string")
    shown = frame.select(
        "t",
        parse_timestamp("t").cast("string").alias("ours"),
        two_patterns("t").cast("timestamp_ntz").cast("string").alias("defining"),
    )
    assert shown.filter("NOT ours <=> defining").collect() == []


def test_parse_mixed(spark):
    rows = [
        ("2016-02-08", dt.datetime(2016, 2, 8)),
        ("2016-02-08T05:46:00", dt.datetime(2016, 2, 8, 5, 46)),
        ("2016-02-08 05:46:00.5", dt.datetime(2016, 2, 8, 5, 46, 0, 500000)),
        ("02/08/2016 05:46", dt.datetime(2016, 2, 8, 5, 46)),
        ("02/08/2016", dt.datetime(2016, 2, 8)),
        ("2016/02/08", dt.datetime(2016, 2, 8)),
        ("08 Feb 2016", dt.datetime(2016, 2, 8)),
        ("2/8/2016", dt.datetime(2016, 2, 8)),
        ("2/8/2016 5:46", dt.datetime(2016, 2, 8, 5, 46)),
        ("02/08/2016 05:46 PM", dt.datetime(2016, 2, 8, 17, 46)),
        ("2/8/2016 5:46:07 am", dt.datetime(2016, 2, 8, 5, 46, 7)),
        ("Feb 8, 2016", dt.datetime(2016, 2, 8)),
        ("February 8, 2016 5:46", dt.datetime(2016, 2, 8, 5, 46)),
        ("2016-02-08T05:46:00Z", dt.datetime(2016, 2, 8, 5, 46)),
        ("2016-02-08 5:46", dt.datetime(2016, 2, 8, 5, 46)),
        ("2016-2-8", dt.datetime(2016, 2, 8)),
        ("2016-2-8 5:46:01.25", dt.datetime(2016, 2, 8, 5, 46, 1, 250000)),
        ("25/12/2016", dt.datetime(2016, 12, 25)),
        ("20160208", dt.datetime(2016, 2, 8)),
        ("13/13/2016", None),
        ("soon", None),
        (None, None),
        ("2016-02-08T05:46:00+05:00", dt.datetime(2016, 2, 8, 5, 46)),
        ("2/8/2016 5:46 PM -0330", dt.datetime(2016, 2, 8, 17, 46)),
        ("8-feb-2016 23:59:59.999999999", dt.datetime(2016, 2, 8, 23, 59, 59, 999999)),
        ("8 FEBRUARY 2016", dt.datetime(2016, 2, 8)),
        ("Feb 30, 2016", None),
        ("2/30/2016", None),
        ("2016-02-08 24:00", None),
        ("2016-02-08 5:60", None),
        ("2016-02-08 5:46:60", None),
        ("2/8/2016 13:00 PM", None),
        ("2/8/2016 0:00 AM", None),
        ("Foo 8, 2016", None),
        ("8.2.2016|5:46", None),
        ("2016-02-08+05:00", None),
        ("", None),
        ("1" * 5000 + " ", None),
    ]
    frame = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = [r[0] for r in frame.select(parse_timestamp_mixed("t")).collect()]
    assert got == [want for _, want in rows]


def test_mixed_offsets_to_utc(spark):
    rows = [
        ("2016-02-08T05:46:00+05:00", dt.datetime(2016, 2, 8, 0, 46)),
        ("2/8/2016 5:46 PM -0330", dt.datetime(2016, 2, 8, 21, 16)),
        ("2016-02-08T05:46:00Z", dt.datetime(2016, 2, 8, 5, 46)),
        ("2016-02-08 5:46", dt.datetime(2016, 2, 8, 5, 46)),
    ]
    frame = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [r[0] for r in frame.select(parse_timestamp_mixed("t", utc=True)).collect()] == [want for _, want in rows]


def patterns_in_order(column):
    """Every pattern tried in turn, the way the shapes are meant to agree with."""
    dates = ("yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
    dates += ("MMM d yyyy", "MMMM d yyyy", "d-MMM-yyyy", "yyyyMMdd", "M-d-yyyy", "d.M.yyyy")
    tried = [F.try_to_timestamp(column, F.lit(d + t)) for d in dates for t in ("[ H:mm[:ss[.SSSSSSSSS]]]", " h:mm[:ss] a")]
    return F.coalesce(*tried).cast("timestamp_ntz")


mixed = st.builds(
    lambda form, y, m, d, name, time: form.format(y=y, m=m, d=d, n=name) + time,
    st.sampled_from(
        ["{y}-{m}-{d}", "{m}/{d}/{y}", "{d}/{m}/{y}", "{y}/{m}/{d}", "{d} {n} {y}", "{n} {d}, {y}", "{n} {d} {y}", "{m}-{d}-{y}", "{d}.{m}.{y}", "{y}{m:02d}{d:02d}"]
    ),
    st.integers(1900, 2100),
    st.integers(0, 14),
    st.integers(0, 32),
    st.sampled_from(["Jan", "Feb", "MAR", "May", "June", "september", "Sep", "Mai", "Febr"]),
    st.sampled_from(["", " 5:46", " 05:46:07", " 23:59:59.25", " 12:00 AM", " 12:30:01 pm", " 0:10 PM", " 24:00", " 5:4", " x", " 5:46:61"]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(mixed, min_size=60, max_size=120))
def test_shapes_agree_with_patterns(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    upper = F.regexp_replace("t", "pm$", "PM")
    shown = frame.select("t", parse_timestamp_mixed("t").alias("ours"), patterns_in_order(upper).alias("defining"))
    assert shown.filter("NOT ours <=> defining").collect() == []


def test_mixed_plan_tries_no_patterns(spark):
    frame = spark.createDataFrame([("x",)], "t string")
    assert "gettimestamp" not in plan_of(frame.select(parse_timestamp_mixed("t"))).lower()


def test_time_parts(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ '2017-01-01 13:59:00' AS t")
    row = frame.select(*[c.alias(n) for n, c in time_parts("t").items()]).first().asDict()
    assert row == {
        "Year": 2017,
        "Month": 1,
        "Weekday": "Sunday",
        "Weekday_Number": 1,
        "Hour": 13,
    }
    week = spark.sql("SELECT explode(sequence(DATE '2017-01-01', DATE '2017-01-14')) AS d")
    names = time_parts("d")
    assert week.filter(names["Weekday"] != F.date_format("d", "EEEE")).count() == 0


def test_timestamp_text_is_pythons(spark):
    values = [dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 1, 0, 0, 0, 123400)]
    frame = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
    assert [r[0] for r in frame.select(timestamp_text("t")).collect()] == [str(v) for v in values]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.integers(0, 1_000_000).map(lambda n: n / 10000)
        | st.floats(0, 1e6)
        | st.sampled_from([14.25, 14.35, 0.125, 2.675, 0.5, 1.5, 99.995]),
        min_size=50,
        max_size=150,
    )
)
def test_fixed_point_is_printf(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = frame.select(
        fixed_point("v", 1), fixed_point("v", 2), round_binary("v", 4), percent_label("v", 1)
    ).collect()
    want = [(f"{v:.1f}", f"{v:.2f}", round(v, 4), f"{v:.1f}%") for v in values]
    assert [tuple(r) for r in got] == want


def test_number_labels(spark):
    frame = spark.createDataFrame([(7728394,), (0,), (999,)], "n bigint")
    got = [tuple(r) for r in frame.select(thousands("n"), millions_label("n")).collect()]
    assert got == [("7,728,394", "7.73M"), ("0", "0.00M"), ("999", "0.00M")]


def test_names(spark):
    assert safe_alias("Temperature(F)") == "Mean_Temperature_F"
    assert safe_alias("Humidity(%)") == "Mean_Humidity_pct"
    assert safe_alias("Wind_Speed(mph)") == "Mean_Wind_Speed_mph"
    assert spark.range(1).select(readable(F.lit("Give_Way"))).first()[0] == "Give Way"
