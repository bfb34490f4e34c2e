"""DuckDB SQL for every query of the catalogue, written independently of it.

``RECORDS`` builds the stand-in records with typed times (``acc``) and with raw text
times (``txt``); ``CLEANED`` adds deduplication, the row rules and the derived columns (``cl``).
"""

from __future__ import annotations

from ..sources.schema import FLAG_COLUMNS, RAW_COLUMNS

START = (
    "o.o_orderdate + to_seconds(l.l_orderkey * 37 % 1440 * 60 + l.l_linenumber * 7 % 60)"
)
MICROS = "(l.l_partkey * 7919 % 1000000)"
JUNK = "(l.l_discount = 0.05 AND l.l_tax = 0.05)"
HOUR_OF_KEY = "((l.l_orderkey * 37 % 1440) // 60)"
LIGHT = f"CASE WHEN {HOUR_OF_KEY} < 6 OR {HOUR_OF_KEY} >= 18 THEN 'Night' ELSE 'Day' END"

CELLS = {
    "ID": "CASE WHEN NOT (l.l_tax = 0.08 AND l.l_discount = 0.01) "
    "THEN l.l_orderkey || '-' || l.l_linenumber END",
    "Source": "'Source' || l.l_returnflag",
    "Severity": "CASE WHEN NOT (l.l_tax = 0.08 AND l.l_discount = 0.02) "
    "THEN CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) END",
    "Start_Time": f"CASE WHEN {JUNK} THEN NULL WHEN l.l_returnflag = 'A' "
    f"THEN {START} + to_microseconds({MICROS}) ELSE {START} END",
    "End_Time": "l.l_shipdate + to_hours(CAST(l.l_quantity AS BIGINT))",
    "Start_Lat": "c.c_acctbal / 250",
    "Start_Lng": "-o.o_totalprice / 4000",
    "End_Lat": "CASE WHEN l.l_linestatus <> 'F' THEN c.c_acctbal / 250 END",
    "End_Lng": "CASE WHEN l.l_linestatus <> 'F' THEN -o.o_totalprice / 4000 END",
    "Distance(mi)": "l.l_discount * l.l_quantity",
    "Description": "l.l_returnflag || ', ' || l.l_linestatus || ', ' || o.o_orderpriority",
    "Street": "'Street ' || l.l_suppkey",
    "City": "CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END",
    "County": "'County ' || n.n_regionkey",
    "State": "CASE WHEN n.n_nationkey <> 24 THEN n.n_name END",
    "Zipcode": "lpad(CAST(o.o_custkey AS VARCHAR), 9, '0')",
    "Country": "'US'",
    "Timezone": "'US/' || n.n_regionkey",
    "Airport_Code": "'K' || n.n_nationkey",
    "Weather_Timestamp": "e.ts",
    "Temperature(F)": "e.value",
    "Wind_Chill(F)": "CASE WHEN e.value <= 50 THEN e.value / 2 END",
    "Humidity(%)": "l.l_quantity * 2",
    "Pressure(in)": "l.l_extendedprice / 1000",
    "Visibility(mi)": "l.l_discount * 100",
    "Wind_Direction": "upper(substr(e.event_type, 1, 2))",
    "Wind_Speed(mph)": "l.l_tax * 100",
    "Precipitation(in)": "e.value / 64",
    "Weather_Condition": "CASE WHEN e.event_type <> 'error' THEN e.event_type END",
    "Amenity": "l.l_discount = 0.1",
    "Bump": "CASE WHEN e.value > 20 THEN o.o_orderstatus = 'P' END",
    "Crossing": "o.o_totalprice > 300000",
    "Give_Way": "l.l_quantity = 1",
    "Junction": "o.o_orderstatus = 'F'",
    "No_Exit": "l.l_linenumber = 7",
    "Railway": "e.event_type = 'view'",
    "Roundabout": "l.l_extendedprice < 1000",
    "Station": "l.l_returnflag = 'R'",
    "Stop": "l.l_linestatus = 'O'",
    "Traffic_Calming": "l.l_tax = 0",
    "Traffic_Signal": "l.l_quantity > 30",
    "Turning_Loop": "false",
    "Sunrise_Sunset": LIGHT,
    "Civil_Twilight": LIGHT,
    "Nautical_Twilight": LIGHT,
    "Astronomical_Twilight": f"CASE WHEN l.l_quantity <> 50 THEN {LIGHT} END",
}
SECOND_TEXT = "'%Y-%m-%d %H:%M:%S'"
TEXT_CELLS = CELLS | {
    "Start_Time": f"CASE WHEN {JUNK} THEN 'n/a' WHEN l.l_returnflag = 'A' "
    f"THEN strftime({START}, {SECOND_TEXT}) || '.' || lpad(CAST({MICROS} AS VARCHAR), 6, '0') || '789' "
    f"ELSE strftime({START}, {SECOND_TEXT}) END",
    "End_Time": f"strftime({CELLS['End_Time']}, {SECOND_TEXT})",
    "Weather_Timestamp": "CAST(e.ts AS VARCHAR)",
}
SOURCE = """
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN events e ON l.l_orderkey = e.event_id
"""


def _select(cells: dict[str, str]) -> str:
    return "SELECT " + ",\n".join(f'{sql} AS "{name}"' for name, sql in cells.items()) + SOURCE


RECORDS = f"WITH acc AS ({_select(CELLS)}), txt AS ({_select(TEXT_CELLS)})"
VALID = '"State" IS NOT NULL AND "Start_Time" IS NOT NULL AND "Severity" BETWEEN 1 AND 4'


def _cleaned(source: str) -> str:
    return f"""
SELECT * REPLACE (coalesce("City", 'Unknown') AS "City"),
  coalesce("City", 'Unknown') || ', ' || "State" AS "City_State",
  CAST(year("Start_Time") AS INTEGER) AS "Year",
  CAST(month("Start_Time") AS INTEGER) AS "Month",
  dayname("Start_Time") AS "Weekday",
  CAST(dayofweek("Start_Time") + 1 AS INTEGER) AS "Weekday_Number",
  CAST(hour("Start_Time") AS INTEGER) AS "Hour",
  CAST("Severity" >= 3 AS INTEGER) AS "Severity_3_4"
FROM {source}
WHERE "ID" IS NOT NULL AND {VALID}
"""


_REST = ", ".join(f'"{name}" ASC NULLS LAST' for name in RAW_COLUMNS if name != "ID")
CLEANED = f"""{RECORDS},
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY {_REST}) AS rn
    FROM acc WHERE "ID" IS NOT NULL
  ) WHERE rn = 1
),
cl AS ({_cleaned('kept')})"""

N = 'count(*) AS "Accident_Count"'
MEAN = 'round(avg("Severity"), 4) AS "Average_Severity"'
RATE = 'round(avg("Severity_3_4") * 100, 4) AS "Severity_3_4_Percentage"'
SHARE = (
    'round(count(*) * 100 / (SELECT count(*) FROM cl), 4) AS "Percentage_of_All_Records"'
)
ALL_FLAGS = " UNION ALL ".join(
    f"""SELECT '{flag}' AS "Feature", coalesce("{flag}", false) AS "Feature_Present",
    {N}, {MEAN}, {RATE} FROM cl GROUP BY 2"""
    for flag in FLAG_COLUMNS
)
WEATHER = "coalesce(\"Weather_Condition\", 'Missing')"
GROUPING = " UNION ALL ".join(
    f"""SELECT '{name}' AS "Dimension", CAST("{name}" AS VARCHAR) AS "Value", {N} FROM %(t)s GROUP BY "{name}" """
    for name in ("State", "Year", "Severity")
)
MASK = " + ".join(
    f'CAST(CASE WHEN "{flag}" THEN {1 << i} ELSE 0 END AS BIGINT)'
    for i, flag in enumerate(FLAG_COLUMNS)
)
ROLLUP_KEYS = {
    "City": ("place", "VARCHAR"),
    "State": ("place", "VARCHAR"),
    "Year": ("time", "INTEGER"),
    "Month": ("time", "INTEGER"),
    "Weekday_Number": ("time", "INTEGER"),
    "Weekday": ("time", "VARCHAR"),
    "Hour": ("time", "INTEGER"),
    "Weather_Condition_Group": ("weather", "VARCHAR"),
    "Feature_Mask": ("feature", "BIGINT"),
}


def _rollup_slice(name: str) -> str:
    own = {"Weather_Condition_Group": WEATHER, "Feature_Mask": MASK}
    cells = [
        f'{own.get(key, chr(34) + key + chr(34))} AS "{key}"'
        if part == name
        else f'CAST(NULL AS {kind}) AS "{key}"'
        for key, (part, kind) in ROLLUP_KEYS.items()
    ]
    return f"SELECT '{name}' AS \"Slice\", {', '.join(cells)}, \"Severity\", {N} FROM cl GROUP BY ALL"


ROLLUP = " UNION ALL ".join(_rollup_slice(n) for n in ("place", "time", "weather", "feature"))
STATE = f"""SELECT "State", {N}, {MEAN}, {RATE}, {SHARE} FROM cl GROUP BY "State" """
WEATHER_REPORT = f"""SELECT {WEATHER} AS "Weather_Condition_Group", {N}, {MEAN}, {RATE}, {SHARE}
FROM cl GROUP BY 1"""
CITY = f"""SELECT "City_State", "City", "State", {N}, {MEAN}, {RATE} FROM cl GROUP BY 1, 2, 3"""
YEAR_MONTH = f"""SELECT "Year", "Month", {N}, {MEAN} FROM cl GROUP BY 1, 2"""
SEVERITY = f"""SELECT "Severity", {N}, {SHARE} FROM cl GROUP BY 1"""
HOURS = f"""SELECT "Hour", {N}, {SHARE} FROM cl GROUP BY 1"""
WEEKDAYS = f"""SELECT "Weekday_Number", "Weekday", {N}, {SHARE} FROM cl GROUP BY 1, 2"""


def _means(columns: dict[str, str], source: str) -> str:
    cells = [f'round(avg("{name}"), 4) AS "{alias}"' for name, alias in columns.items()]
    return f"SELECT {', '.join(cells)} FROM {source}"


def _top(query: str, label: str, where: str = "true") -> str:
    return f"""SELECT "{label}", "Accident_Count", format('{{:,}}', "Accident_Count") AS "Label"
FROM ({query}) WHERE {where} ORDER BY "Accident_Count" DESC, "{label}" LIMIT 10"""


def _time_text(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 'None' WHEN epoch_us({column}) % 1000000 = 0 "
        f"THEN strftime({column}, {SECOND_TEXT}) ELSE strftime({column}, '%Y-%m-%d %H:%M:%S.%f') END"
    )


QUALITY = f"""{RECORDS}, p AS (
  SELECT count(*) AS n, count(DISTINCT "ID") AS ids, count(*) - count("ID") AS no_id,
    count(*) FILTER (WHERE "Severity" NOT BETWEEN 1 AND 4) AS bad,
    min("Start_Time") AS lo, max("Start_Time") AS hi FROM acc)
SELECT 'input_uri' AS metric, 'incidents' AS value
UNION ALL SELECT 'row_count', CAST(n AS VARCHAR) FROM p
UNION ALL SELECT 'column_count', '46'
UNION ALL SELECT 'distinct_id_count', CAST(ids AS VARCHAR) FROM p
UNION ALL SELECT 'duplicate_or_null_id_difference', CAST(n - ids AS VARCHAR) FROM p
UNION ALL SELECT 'null_id_count', CAST(no_id AS VARCHAR) FROM p
UNION ALL SELECT 'invalid_severity_count', CAST(bad AS VARCHAR) FROM p
UNION ALL SELECT 'minimum_start_time', {_time_text('lo')} FROM p
UNION ALL SELECT 'maximum_start_time', {_time_text('hi')} FROM p"""
MISSING = f"{RECORDS} " + " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) - count("{name}") AS missing_count,
    CAST(printf('%.4f', 100.0::DOUBLE * (count(*) - count("{name}")) / count(*)) AS DOUBLE)
    AS missing_percentage FROM acc"""
    for name in RAW_COLUMNS
)
VALIDATION = f"""{CLEANED}, n AS (SELECT (SELECT count(*) FROM acc) AS raw, (SELECT count(*) FROM cl) AS clean)
SELECT 'cleaned_row_count' AS "check", CAST(clean AS VARCHAR) AS value FROM n
UNION ALL SELECT 'rows_removed', CAST(raw - clean AS VARCHAR) FROM n
UNION ALL SELECT 'processed_uri', 'cleaned'
UNION ALL SELECT 'status', CASE WHEN clean <= raw THEN 'PASS' ELSE 'FAIL' END FROM n"""


def _reconciliation(info: bool) -> str:
    checks = [
        ("input_row_count", "SELECT count(*) FROM cl"),
        ("state_count_sum", 'SELECT sum(n) FROM (SELECT count(*) n FROM cl GROUP BY "State")'),
        ("year_count_sum", 'SELECT sum(n) FROM (SELECT count(*) n FROM cl GROUP BY "Year")'),
        ("severity_count_sum", 'SELECT sum(n) FROM (SELECT count(*) n FROM cl GROUP BY "Severity")'),
    ]
    parts = [
        f"""SELECT '{name}' AS "Check", CAST(v AS VARCHAR) AS "Value",
        CASE WHEN v = (SELECT count(*) FROM cl) THEN 'PASS' ELSE 'FAIL' END AS "Status"
        FROM ({sql}) AS t(v)"""
        for name, sql in checks
    ]
    if info:
        parts += ["SELECT 'input_uri', 'cleaned', 'INFO'", "SELECT 'output_uri', 'reports', 'INFO'"]
    return f"{CLEANED} " + " UNION ALL ".join(parts)


DIMENSION_CHECK = f"{CLEANED} " + " UNION ALL ".join(
    f"""SELECT '{name}' AS "Dimension", count("{name}") AS "Total", count(*) AS "Expected",
    CASE WHEN count("{name}") = count(*) THEN 'PASS' ELSE 'FAIL' END AS "Status" FROM cl"""
    for name in ("State", "Year", "Severity", "Weather_Condition")
)
FIVE_WAY = f"""{RECORDS}, n AS (
  SELECT count(*) AS input, count(*) FILTER (WHERE {VALID}) AS valid FROM acc)
SELECT 'input_rows' AS "Check", CAST(input AS VARCHAR) AS "Value", 'PASS' AS "Status" FROM n
""" + "".join(
    f"""UNION ALL SELECT '{name}', CAST(valid AS VARCHAR),
    CASE WHEN valid = input THEN 'PASS' ELSE 'FAIL' END FROM n\n"""
    for name in ("valid_rows", "state_total", "year_total", "severity_total")
)
RUN = "CASE \"Source\" WHEN 'SourceA' THEN 1 WHEN 'SourceN' THEN 2 ELSE 3 END"
RUN_SECONDS = 'round(avg("Humidity(%)"), 4)'
RUNS = f"""SELECT {RUN} AS run, {RUN_SECONDS} AS total_seconds, count("State") AS state_total,
  count("Year") AS year_total, count("Severity") AS severity_total,
  'PASS' AS reconciliation_status, 'run_' || CAST({RUN} AS VARCHAR) AS output_uri
FROM cl GROUP BY {RUN}"""
RUN_SUMMARY = f"""{CLEANED}, r AS ({RUNS})
SELECT 'framework' AS metric, 'PySpark' AS value
UNION ALL SELECT unnest(['spark_version', 'spark_master', 'default_parallelism', 'shuffle_partitions', 'input_uri']), 'named'
UNION ALL SELECT 'timing_scope', 'records'
UNION ALL SELECT 'runs', CAST(count(*) AS VARCHAR) FROM r
UNION ALL SELECT 'median_total_seconds', CAST(round(median(total_seconds), 4) AS VARCHAR) FROM r
UNION ALL SELECT 'all_runs_reconciled', CAST(bool_and(reconciliation_status = 'PASS') AS VARCHAR) FROM r
UNION ALL SELECT 'cluster_provisioning_time_included', 'false'"""
RUN_METRICS = f"""{RECORDS}
SELECT {RUN} AS run, count(*) AS input_rows, count(*) FILTER (WHERE {VALID}) AS valid_rows,
  round(avg("Humidity(%)"), 4) AS scan_and_aggregate_seconds,
  round(avg("Visibility(mi)"), 4) AS write_seconds,
  round(avg("Humidity(%)") + avg("Visibility(mi)"), 4) AS total_seconds,
  CASE WHEN count(*) = count(*) FILTER (WHERE {VALID}) THEN 'PASS' ELSE 'FAIL' END
    AS reconciliation_status
FROM acc GROUP BY 1"""
RUNTIMES = f"""{CLEANED},
a AS (SELECT {RUN} AS run, {RUN_SECONDS} AS s FROM cl WHERE "Stop" GROUP BY 1),
b AS (SELECT {RUN} AS run, {RUN_SECONDS} AS s FROM cl WHERE NOT "Stop" GROUP BY 1)
SELECT a.run, a.s AS "Pandas", b.s AS "PySpark",
  printf('%.2f', a.s) AS "Pandas_Label", printf('%.2f', b.s) AS "PySpark_Label"
FROM a JOIN b ON a.run = b.run"""
METRIC_ROWS = f"""{CLEANED}
SELECT 'row_count' AS metric, CAST(count(*) AS VARCHAR) AS value FROM cl
UNION ALL SELECT 'levels', '[' || string_agg(CAST(s AS VARCHAR), ',' ORDER BY s) || ']'
  FROM (SELECT DISTINCT "Severity" AS s FROM cl)
UNION ALL SELECT 'levels_in_range', CAST(max("Severity") <= 4 AS VARCHAR) FROM cl
UNION ALL SELECT 'years', '{{"first":' || min("Year") || ',"last":' || max("Year") || '}}' FROM cl"""
EVENT_TEXT = f"""CASE WHEN event_type = 'error' THEN 'n/a'
  WHEN event_type = 'signup' THEN strftime(ts, {SECOND_TEXT}) || chr(CASE event_id % 4 WHEN 0 THEN 10 WHEN 1 THEN 13
    WHEN 2 THEN 133 ELSE 8232 END)
  WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '789'
  ELSE strftime(ts, {SECOND_TEXT}) END"""
def _day(form: str) -> str:
    return f"strftime(o_orderdate, '{form}')"


# Text forms by order key, and the minutes after midnight that each says.
MIXED_FORMS = (
    (_day("%Y-%m-%d"), 0),
    (f"{_day('%Y-%m-%d')} || 'T08:30:00'", 510),
    (_day("%m/%d/%Y"), 0),
    (f"{_day('%m/%d/%Y')} || ' 17:45'", 1065),
    (_day("%-m/%-d/%Y"), 0),
    (f"{_day('%-m/%-d/%Y')} || ' 5:46'", 346),
    (f"{_day('%m/%d/%Y')} || ' 05:46 PM'", 1066),
    (_day("%b %-d, %Y"), 0),
    (f"{_day('%Y-%m-%d')} || 'T05:46:00Z'", 346),
    (f"{_day('%Y-%m-%d')} || ' 5:46'", 346),
    (_day("%Y-%-m-%-d"), 0),
    (f"'on ' || {_day('%Y-%m-%d')}", None),
    (f"{_day('%Y-%m-%d')} || 'T05:46:00+05:00'", 346),
    (f"{_day('%-d.%-m.%Y')} || ' 5:46 -0330'", 346),
)
_FORM = f"o_orderkey % {len(MIXED_FORMS)}"
MIXED = f"""SELECT o_orderkey,
  CASE {_FORM} {' '.join(f'WHEN {i} THEN {text}' for i, (text, _) in enumerate(MIXED_FORMS))} END AS text,
  o_orderdate + to_minutes(CASE {_FORM}
    {' '.join(f'WHEN {i} THEN {m}' for i, (_, m) in enumerate(MIXED_FORMS) if m is not None)} END) AS moment
FROM orders"""
LABELS = """WITH t AS (
  SELECT o_orderstatus, o_orderpriority, count(*) AS "Order_Count",
    round(avg(o_totalprice), 4) AS "Average_Price",
    round(count(*) * 100 / (SELECT count(*) FROM orders), 4) AS "Share"
  FROM orders GROUP BY 1, 2)
SELECT *, format('{:,}', "Order_Count") AS "Count_Label", printf('%.1f%%', "Share") AS "Share_Label",
  printf('%.2f', "Average_Price") AS "Price_Label",
  CAST(printf('%.2f', "Share") AS DOUBLE) AS "Share_Rounded" FROM t"""
LINE_KEY = "l_orderkey, l_linenumber"
DEDUP_LINES = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {LINE_KEY} ORDER BY l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1"""


def _long(report: str, query: str, keys: list[str], measures: list[str]) -> str:
    """A report as (Report, Key, Measure, Value) rows, a row per measure."""
    key = "concat_ws('|', " + ", ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) + ")"
    return " UNION ALL ".join(
        f"""SELECT '{report}' AS "Report", {key if keys else "''"} AS "Key", '{m}' AS "Measure",
        CAST("{m}" AS DOUBLE) AS "Value" FROM ({query})"""
        for m in measures
    )


COUNT_, MEAN_, RATE_, SHARE_ = (
    "Accident_Count", "Average_Severity", "Severity_3_4_Percentage", "Percentage_of_All_Records"
)
MEANS = {
    "Temperature(F)": "Mean_Temperature_F",
    "Humidity(%)": "Mean_Humidity_pct",
    "Pressure(in)": "Mean_Pressure_in",
    "Visibility(mi)": "Mean_Visibility_mi",
    "Wind_Speed(mph)": "Mean_Wind_Speed_mph",
    "Precipitation(in)": "Mean_Precipitation_in",
}
CITIES = f'{CITY} ORDER BY "Accident_Count" DESC, "City_State" LIMIT 100'
ANALYSIS_TABLES = f"{CLEANED} " + " UNION ALL ".join(
    [
        _long("state_summary", STATE, ["State"], [COUNT_, MEAN_, RATE_, SHARE_]),
        _long("top_100_cities_by_count", CITIES, ["City_State", "City", "State"], [COUNT_, MEAN_, RATE_]),
        _long("year_summary", f'SELECT "Year", {N}, {MEAN}, {RATE} FROM cl GROUP BY 1', ["Year"], [COUNT_, MEAN_, RATE_]),
        _long("year_month_summary", YEAR_MONTH, ["Year", "Month"], [COUNT_, MEAN_]),
        _long("weekday_summary", WEEKDAYS, ["Weekday_Number", "Weekday"], [COUNT_, SHARE_]),
        _long("hour_summary", HOURS, ["Hour"], [COUNT_, SHARE_]),
        _long(
            "weekday_hour_summary",
            f'SELECT "Weekday_Number", "Weekday", "Hour", {N} FROM cl GROUP BY 1, 2, 3',
            ["Weekday_Number", "Weekday", "Hour"],
            [COUNT_],
        ),
        _long("severity_distribution", SEVERITY, ["Severity"], [COUNT_, SHARE_]),
        _long("weather_condition_summary", WEATHER_REPORT, ["Weather_Condition_Group"], [COUNT_, MEAN_, RATE_, SHARE_]),
        _long("numeric_weather_overall", _means(MEANS, "cl"), [], list(MEANS.values())),
        _long("road_feature_summary", ALL_FLAGS, ["Feature", "Feature_Present"], [COUNT_, MEAN_, RATE_]),
    ]
)
PREPARE_TABLES = f"""{CLEANED}, q AS ({QUALITY.removeprefix(RECORDS).replace(', p AS', 'WITH p AS', 1)}),
m AS ({MISSING.removeprefix(RECORDS)}), v AS ({VALIDATION.removeprefix(CLEANED).replace(', n AS', 'WITH n AS', 1)})
SELECT 'summary' AS "Table", metric AS "Name", value AS "Value" FROM q WHERE metric <> 'input_uri'
UNION ALL SELECT 'missing_values', "column", CAST(missing_count AS VARCHAR) FROM m
UNION ALL SELECT 'missing_percentage', "column", printf('%.4f', missing_percentage) FROM m
UNION ALL SELECT 'validation', "check", value FROM v WHERE "check" <> 'processed_uri'"""
SPLIT_TABLES = f"""{RECORDS}, ok AS (SELECT *, CAST(year("Start_Time") AS INTEGER) AS "Year" FROM acc WHERE {VALID}),
n AS (SELECT count(*) AS input, (SELECT count(*) FROM ok) AS valid FROM acc)
SELECT lower("Dimension") || '_counts' AS "Table", "Value" AS "Name", CAST("Accident_Count" AS VARCHAR) AS "Value"
FROM ({GROUPING % {'t': 'ok'}})
UNION ALL SELECT 'run_metrics', 'input_rows', CAST(input AS VARCHAR) FROM n
UNION ALL SELECT 'run_metrics', 'valid_rows', CAST(valid AS VARCHAR) FROM n
UNION ALL SELECT 'run_metrics', 'reconciliation_status', CASE WHEN input = valid THEN 'PASS' ELSE 'FAIL' END FROM n
UNION ALL SELECT 'summary', 'framework', 'PySpark'
UNION ALL SELECT 'summary', 'columns_used', 'State,Severity,Start_Time'
UNION ALL SELECT 'summary', 'runs', '1'
UNION ALL SELECT 'summary', 'all_runs_reconciled', CAST(input = valid AS VARCHAR) FROM n"""

BROKEN = {
    "Severity": "\"Zipcode\" LIKE '%7'",
    "Distance(mi)": "\"Street\" = 'Street 5'",
    "Stop": "\"Airport_Code\" = 'K3'",
}
_ANY = " OR ".join(f"coalesce({test}, false)" for test in BROKEN.values())
QUARANTINE = f"""{RECORDS}
SELECT 'raw' AS "Check", CAST(NULL AS VARCHAR) AS "Column", count(*) AS "Row_Count" FROM acc
UNION ALL SELECT 'good', NULL, count(*) FROM acc WHERE NOT ({_ANY})
UNION ALL SELECT 'quarantined', NULL, count(*) FROM acc WHERE {_ANY}""" + "".join(
    f"""
UNION ALL SELECT 'malformed', '{name}', count(*) FROM acc WHERE {test} HAVING count(*) > 0"""
    for name, test in BROKEN.items()
)
DEDUP_BY_DATE = DEDUP_LINES.replace("ORDER BY l_partkey", "ORDER BY coalesce(l_shipdate >= '1997-01-01', true), l_partkey")
CONTENT = " UNION ALL ".join(
    f"""SELECT '{copy}' AS "Copy", '{check}' AS "Check", '{status}' AS "Status" """
    for copy, hashes in (("stored", "PASS"), ("one cell changed", "FAIL"))
    for check, status in (("row_count", "PASS"), ("hash_sum", hashes), ("hash_xor", hashes))
)
QUANTILES = f"{CLEANED} " + " UNION ALL ".join(
    f"""SELECT "State", CAST({share} AS DOUBLE) AS share, count("Pressure(in)") AS row_count,
    round(quantile_cont("Pressure(in)", {share}), 9) AS quantile FROM cl GROUP BY "State" """
    for share in (0.25, 0.5, 0.9)
)
RANGES = f"""{CLEANED} SELECT 'row_count' AS metric, count(*) AS value FROM cl""" + "".join(
    f""" UNION ALL SELECT '{label}_{name}', CAST({f}("{name}") AS BIGINT) FROM cl"""
    for name, fs in (
        ("Severity", ("min", "max")), ("Month", ("min", "max")), ("Hour", ("min", "max")),
        ("Weather_Condition", ("count",)), ("End_Lat", ("count",)),
    )
    for f, label in ((f, {"min": "minimum", "max": "maximum", "count": "count"}[f]) for f in fs)
)

ORACLES: dict[str, str] = {
    "incremental_counts": RECORDS
    + ', ok AS (SELECT *, CAST(year("Start_Time") AS INTEGER) AS "Year" FROM acc '
    + f"WHERE {VALID}) {GROUPING % {'t': 'ok'}}",
    "dedup_increment": DEDUP_BY_DATE,
    "year_rewrite": f"{CLEANED} SELECT * FROM cl",
    "csv_quarantine": QUARANTINE,
    "content_checks": CONTENT,
    "distinct_sketches_by_year": f"""{CLEANED} SELECT "Year", count(DISTINCT "Zipcode") AS "Exact_Count",
      true AS "Within_Bound" FROM cl GROUP BY GROUPING SETS (("Year"), ())""",
    "quantiles_by_state": QUANTILES,
    "largest_groups": f"""{CLEANED} SELECT CASE WHEN "Hour" < 8 THEN "City_State" ELSE "ID" END AS "Place", {N}
      FROM cl GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
    "largest_cities": f"""{CLEANED} SELECT "City_State", {N} FROM cl GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100""",
    "stored_ranges": RANGES,
    "state_summary": f"{CLEANED} {STATE}",
    "top_cities": f'{CLEANED} {CITY} ORDER BY "Accident_Count" DESC, "City_State" LIMIT 100',
    "city_severity_min": f"{CLEANED} {CITY} HAVING count(*) >= 20",
    "city_summary_from_rows": f'{CLEANED} SELECT "City_State", "City", "State", {N}, {MEAN}, '
    f"{RATE}, {SHARE} FROM cl GROUP BY 1, 2, 3",
    "year_summary": f'{CLEANED} SELECT "Year", {N}, {MEAN}, {RATE} FROM cl GROUP BY 1',
    "year_month_summary": f"{CLEANED} {YEAR_MONTH}",
    "weekday_summary": f"{CLEANED} {WEEKDAYS}",
    "hour_summary": f"{CLEANED} {HOURS}",
    "weekday_hour_summary": f'{CLEANED} SELECT "Weekday_Number", "Weekday", "Hour", {N} '
    "FROM cl GROUP BY 1, 2, 3",
    "event_weekday_hour": f"""SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS "Weekday_Number",
      dayname(ts) AS "Weekday", CAST(hour(ts) AS INTEGER) AS "Hour", {N},
      round(avg(value), 4) AS "Average_Value" FROM events GROUP BY 1, 2, 3""",
    "severity_distribution": f"{CLEANED} {SEVERITY}",
    "weather_condition_summary": f"{CLEANED} {WEATHER_REPORT}",
    "numeric_weather_overall": CLEANED
    + " "
    + _means(
        {
            "Temperature(F)": "Mean_Temperature_F",
            "Humidity(%)": "Mean_Humidity_pct",
            "Pressure(in)": "Mean_Pressure_in",
            "Visibility(mi)": "Mean_Visibility_mi",
            "Wind_Speed(mph)": "Mean_Wind_Speed_mph",
            "Precipitation(in)": "Mean_Precipitation_in",
        },
        "cl",
    ),
    "numeric_means_lineitem": _means(
        {n: f"Mean_{n}" for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
        "lineitem",
    ),
    "road_feature_summary": f"{CLEANED} {ALL_FLAGS}",
    "road_feature_summary_unpivot": f"{CLEANED} {ALL_FLAGS}",
    "road_feature_summary_union": f"{CLEANED} {ALL_FLAGS}",
    "incident_rollup": f"{CLEANED} {ROLLUP}",
    "state_summary_from_rollup": f"{CLEANED} {STATE}",
    "weather_summary_from_rollup": f"{CLEANED} {WEATHER_REPORT}",
    "year_month_from_rollup": f"{CLEANED} {YEAR_MONTH}",
    "road_features_from_rollup": f"{CLEANED} {ALL_FLAGS}",
    "grouping_sets_counts": f"{CLEANED} {GROUPING % {'t': 'cl'}}",
    "grouping_sets_counts_sql": f"{CLEANED} {GROUPING % {'t': 'cl'}}",
    "counts_by_state": f'{CLEANED} SELECT "State", {N} FROM cl GROUP BY 1',
    "counts_by_year": f'{CLEANED} SELECT "Year", {N} FROM cl GROUP BY 1',
    "counts_by_severity": f'{CLEANED} SELECT "Severity", {N} FROM cl GROUP BY 1',
    "value_counts_weather": f'{CLEANED} SELECT "Weather_Condition", {N} FROM cl GROUP BY 1',
    "quality_summary": QUALITY,
    "missing_values": MISSING,
    "duplicate_metrics": f"""SELECT count(*) AS row_count, count(DISTINCT ({LINE_KEY})) AS distinct_count,
      count(*) - count(DISTINCT ({LINE_KEY})) AS difference FROM lineitem""",
    "dedup_keep_first": DEDUP_LINES,
    "typed_rows": f"{RECORDS} SELECT * FROM acc",
    "clean_rows": f"{CLEANED} SELECT * FROM cl",
    "parse_timestamps": f"""SELECT event_id, {EVENT_TEXT} AS text, CASE WHEN event_type NOT IN ('error', 'signup')
      THEN CASE WHEN event_type IN ('view', 'click') THEN ts ELSE date_trunc('second', ts) END END AS moment
      FROM events""",
    "parse_timestamps_mixed": MIXED,
    "label_texts": LABELS,
    "csv_roundtrip": f"{RECORDS} SELECT * FROM txt",
    "csv_grouping_counts": RECORDS
    + ', ok AS (SELECT *, CAST(year("Start_Time") AS INTEGER) AS "Year" FROM acc '
    + f"WHERE {VALID}) {GROUPING % {'t': 'ok'}}",
    "partitioned_roundtrip": f"{CLEANED} SELECT * FROM cl",
    "summary_csv_roundtrip": f"{CLEANED} {ALL_FLAGS}",
    "metrics_json_roundtrip": f"""{RECORDS} SELECT count(*) AS input_rows,
      count(*) FILTER (WHERE "ID" IS NOT NULL AND {VALID}) AS valid_rows FROM acc""",
    "metric_rows": METRIC_ROWS,
    "prepare_then_state_summary": f"{CLEANED} {STATE}",
    "analysis_job_outputs": _reconciliation(False)
    + """ UNION ALL SELECT "City_State", CAST(count(*) AS VARCHAR), 'CITY' FROM cl
      GROUP BY "City_State" HAVING count(*) >= 20""",
    "analysis_job_tables": ANALYSIS_TABLES,
    "prepare_job_tables": PREPARE_TABLES,
    "split_benchmark_job_tables": SPLIT_TABLES,
    "inferred_csv_reread": f"{CLEANED} {ALL_FLAGS}",
    "benchmark_job_totals": f"""{RECORDS}, n AS (
      SELECT count(*) FILTER (WHERE {VALID}) AS valid, count(*) AS input FROM acc)
      SELECT CAST(run AS INTEGER) AS run, valid AS state_total, valid AS year_total,
        valid AS severity_total, CASE WHEN valid = input THEN 'PASS' ELSE 'FAIL' END
        AS reconciliation_status FROM n, range(1, 3) AS r(run)""",
    "split_benchmark_job_rows": f"""{RECORDS} SELECT 1 AS run, count(*) AS input_rows,
      count(*) FILTER (WHERE {VALID}) AS valid_rows, CASE WHEN count(*) FILTER (WHERE {VALID}) = count(*)
      THEN 'PASS' ELSE 'FAIL' END AS reconciliation_status FROM acc""",
    "validation": VALIDATION,
    "reconciliation": _reconciliation(True),
    "reconciliation_from_rollup": _reconciliation(False),
    "dimension_check": DIMENSION_CHECK,
    "five_way_check": FIVE_WAY,
    "benchmark_runs": f"{CLEANED} {RUNS}",
    "benchmark_summary": RUN_SUMMARY,
    "run_metrics": RUN_METRICS,
    "runtime_side_by_side": RUNTIMES,
    "chart_top_states": f"{CLEANED} {_top(STATE, 'State')}",
    "chart_top_cities": f"{CLEANED} {_top(CITY, 'City_State')}",
    "chart_yearly": f"""{CLEANED} SELECT "Year", {N}, "Year" IN (1995, 2001) AS "Is_Partial_Year",
      printf('%.2fM', count(*) / 1e6) AS "Label" FROM cl GROUP BY 1""",
    "chart_weekdays": f"""{CLEANED} SELECT "Weekday_Number", "Weekday", "Accident_Count",
      printf('%.1f%%', "Percentage_of_All_Records") AS "Label" FROM ({WEEKDAYS})""",
    "chart_hourly": f'{CLEANED} SELECT "Hour", "Accident_Count" FROM ({HOURS})',
    "chart_severity": f"""{CLEANED} SELECT "Severity", "Percentage_of_All_Records",
      printf('%.2f%%', "Percentage_of_All_Records") AS "Label",
      max("Percentage_of_All_Records") OVER () * 1.18::DOUBLE AS "Axis_Limit" FROM ({SEVERITY})""",
    "chart_weather": CLEANED
    + " "
    + _top(WEATHER_REPORT, "Weather_Condition_Group", "\"Weather_Condition_Group\" <> 'Missing'"),
    "chart_features": f"""{CLEANED} SELECT replace("Feature", '_', ' ') AS "Feature", "Accident_Count",
      format('{{:,}}', "Accident_Count") AS "Label" FROM ({ALL_FLAGS})
      WHERE "Feature_Present" AND "Feature" <> 'Turning_Loop'""",
}
