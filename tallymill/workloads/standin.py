"""Incident records made from the driver's tables.

Every lineitem row becomes one record with the 46 columns of the raw file; its order,
customer, nation and event supply the rest.  IDs repeat where order and line number
do.  Some cells are dirty (no ID, no or invalid severity, text that is no timestamp,
missing place or weather), decided by values of the row, so that each rule meets rows
it must act on.  All rows enter; nothing is sampled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import clean, numbered, retype_times
from ..sinks.writers import let_go, shared_folder, staged
from ..sources.schema import FLAG_COLUMNS, RAW_COLUMNS, TIME_COLUMNS

# What each report slice reads beyond those.
SLICE_COLUMNS = {
    "place": [],
    "time": [],
    "weather": ["Weather_Condition"],
    "feature": FLAG_COLUMNS,
}
# Cells that come from the record's event, if it has one.
EVENT_COLUMNS = {
    "Weather_Timestamp",
    "Temperature(F)",
    "Wind_Chill(F)",
    "Wind_Direction",
    "Precipitation(in)",
    "Weather_Condition",
    "Bump",
    "Railway",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


START = (
    "timestampadd(SECOND, l_orderkey * 37 % 1440 * 60 + l_linenumber * 7 % 60, o_orderdate)"
)
MICROS = "l_partkey * 7919 % 1000000"
JUNK = "l_discount = 0.05 AND l_tax = 0.05"
END = "timestampadd(HOUR, CAST(l_quantity AS BIGINT), l_shipdate)"
LIGHT = "IF(l_orderkey * 37 % 1440 BETWEEN 360 AND 1079, 'Day', 'Night')"

# The timestamp columns as raw text.
TIME_TEXTS = {
    "Start_Time": f"CASE WHEN {JUNK} THEN 'n/a' ELSE concat(CAST({START} AS STRING), "
    f"IF(l_returnflag = 'A', concat('.', lpad(CAST({MICROS} AS STRING), 6, '0'), '789'), '')) END",
    "End_Time": f"CAST({END} AS STRING)",
    "Weather_Timestamp": "CAST(ts AS STRING)",
}
CELLS = {
    "ID": "CASE WHEN l_tax <> 0.08 OR l_discount <> 0.01 "
    "THEN concat_ws('-', l_orderkey, l_linenumber) END",
    "Source": "concat('Source', l_returnflag)",
    "Severity": "CASE WHEN l_tax <> 0.08 OR l_discount <> 0.02 "
    "THEN CAST(substr(o_orderpriority, 1, 1) AS INT) END",
    "Start_Lat": "c_acctbal / 250",
    "Start_Lng": "-o_totalprice / 4000",
    "End_Lat": "CASE WHEN l_linestatus <> 'F' THEN c_acctbal / 250 END",
    "End_Lng": "CASE WHEN l_linestatus <> 'F' THEN -o_totalprice / 4000 END",
    "Distance(mi)": "l_discount * l_quantity",
    "Description": "concat_ws(', ', l_returnflag, l_linestatus, o_orderpriority)",
    "Street": "concat('Street ', l_suppkey)",
    "City": "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END",
    "County": "concat('County ', n_regionkey)",
    "State": "CASE WHEN n_nationkey <> 24 THEN n_name END",
    "Zipcode": "lpad(CAST(o_custkey AS STRING), 9, '0')",
    "Country": "'US'",
    "Timezone": "concat('US/', n_regionkey)",
    "Airport_Code": "concat('K', n_nationkey)",
    "Temperature(F)": "value",
    "Wind_Chill(F)": "CASE WHEN value <= 50 THEN value / 2 END",
    "Humidity(%)": "l_quantity * 2",
    "Pressure(in)": "l_extendedprice / 1000",
    "Visibility(mi)": "l_discount * 100",
    "Wind_Direction": "upper(substr(event_type, 1, 2))",
    "Wind_Speed(mph)": "l_tax * 100",
    "Precipitation(in)": "value / 64",
    "Weather_Condition": "CASE WHEN event_type <> 'error' THEN event_type END",
    "Amenity": "l_discount = 0.1",
    "Bump": "CASE WHEN value > 20 THEN o_orderstatus = 'P' END",
    "Crossing": "o_totalprice > 300000",
    "Give_Way": "l_quantity = 1",
    "Junction": "o_orderstatus = 'F'",
    "No_Exit": "l_linenumber = 7",
    "Railway": "event_type = 'view'",
    "Roundabout": "l_extendedprice < 1000",
    "Station": "l_returnflag = 'R'",
    "Stop": "l_linestatus = 'O'",
    "Traffic_Calming": "l_tax = 0",
    "Traffic_Signal": "l_quantity > 30",
    "Turning_Loop": "false",
    "Sunrise_Sunset": LIGHT,
    "Civil_Twilight": LIGHT,
    "Nautical_Twilight": LIGHT,
    "Astronomical_Twilight": f"CASE WHEN l_quantity <> 50 THEN {LIGHT} END",
}


def raw_incidents(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(RAW_COLUMNS), folder: str | None = None
) -> DataFrame:
    """The raw table, or some of its columns: timestamps are text, as in the raw file.

    The facts of an order are put together and stored before lineitem joins them.  So the
    largest table takes part in one join, on one key, and both sides of it come from an exchange
    of their own; that is what adaptive execution needs to split an order that
    holds a large share of the rows.  Of the facts only what the cells name is joined on and stored, in ``folder`` or one of its own.
    """
    cells = CELLS | TIME_TEXTS
    named = set(re.findall(r"\w+", " ".join(cells[name] for name in columns)))
    facts = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    if EVENT_COLUMNS & set(columns):
        events = table(spark, sf_dir, "events")
        facts = facts.join(events, F.col("o_orderkey") == F.col("event_id"), "left")
    facts = facts.select(*[name for name in facts.columns if name in named | {"o_orderkey"}])
    facts = staged(facts, f"{folder or shared_folder(spark)}/facts", "zstd")
    lineitem = table(spark, sf_dir, "lineitem")
    joined = lineitem.join(facts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.selectExpr(*[f"{cells[name]} AS `{name}`" for name in columns])


def typed_incidents(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(RAW_COLUMNS), folder: str | None = None
) -> DataFrame:
    """The raw table, or some of its columns, with its texts parsed."""
    raw = raw_incidents(spark, sf_dir, columns, folder)
    return retype_times(raw, [name for name in TIME_COLUMNS if name in columns])


def cleaned_incidents(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The stored cleaned dataset: raw text, parsed, deduplicated and put through the rules.

    It is written once per call to the shared folder, as the prepare job does, and reports
    read the columns they need from there.  With ``folder`` it is ``cleaned`` in there, for ``read_slices`` too, and is made
    from stored typed rows, so that no exchange has whole ones.
    """
    if folder is None:
        return staged(clean(typed_incidents(spark, sf_dir)), f"{shared_folder(spark)}/cleaned", "zstd")
    made = f"{folder}/made"
    try:
        typed = staged(numbered(typed_incidents(spark, sf_dir, folder=made)), f"{made}/typed", "zstd")
        let_go(spark, f"{made}/facts")
        return staged(clean(typed, folder=made), f"{folder}/cleaned", "zstd", sliced=True)
    finally:
        let_go(spark, made)
