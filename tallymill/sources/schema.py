"""Column layout of the raw file, the cleaned dataset and the result tables."""

from __future__ import annotations

import re

# The raw file's columns and types, in file order.  CSV columns
# map onto these by position, so the order is part of the format.
RAW_DDL = """
`ID` STRING,
`Source` STRING,
`Severity` INT,
`Start_Time` STRING,
`End_Time` STRING,
`Start_Lat` DOUBLE,
`Start_Lng` DOUBLE,
`End_Lat` DOUBLE,
`End_Lng` DOUBLE,
`Distance(mi)` DOUBLE,
`Description` STRING,
`Street` STRING,
`City` STRING,
`County` STRING,
`State` STRING,
`Zipcode` STRING,
`Country` STRING,
`Timezone` STRING,
`Airport_Code` STRING,
`Weather_Timestamp` STRING,
`Temperature(F)` DOUBLE,
`Wind_Chill(F)` DOUBLE,
`Humidity(%)` DOUBLE,
`Pressure(in)` DOUBLE,
`Visibility(mi)` DOUBLE,
`Wind_Direction` STRING,
`Wind_Speed(mph)` DOUBLE,
`Precipitation(in)` DOUBLE,
`Weather_Condition` STRING,
`Amenity` BOOLEAN,
`Bump` BOOLEAN,
`Crossing` BOOLEAN,
`Give_Way` BOOLEAN,
`Junction` BOOLEAN,
`No_Exit` BOOLEAN,
`Railway` BOOLEAN,
`Roundabout` BOOLEAN,
`Station` BOOLEAN,
`Stop` BOOLEAN,
`Traffic_Calming` BOOLEAN,
`Traffic_Signal` BOOLEAN,
`Turning_Loop` BOOLEAN,
`Sunrise_Sunset` STRING,
`Civil_Twilight` STRING,
`Nautical_Twilight` STRING,
`Astronomical_Twilight` STRING
"""

RAW_COLUMNS = re.findall(r"`([^`]+)`", RAW_DDL)
FLAG_COLUMNS = re.findall(r"`([^`]+)` BOOLEAN", RAW_DDL)

# Text columns that hold timestamps, and the measures whose
# overall means are reported.
TIME_COLUMNS = ["Start_Time", "End_Time", "Weather_Timestamp"]
WEATHER_MEASURES = [
    "Temperature(F)",
    "Humidity(%)",
    "Pressure(in)",
    "Visibility(mi)",
    "Wind_Speed(mph)",
    "Precipitation(in)",
]

# Columns the row rules and the benchmark counts need.
COUNT_COLUMNS = ["State", "Severity", "Start_Time"]

# Layouts of the published result tables.
RESULT_DDL = {
    "state_summary": "State STRING, Accident_Count BIGINT, Average_Severity DOUBLE, "
    "Severity_3_4_Percentage DOUBLE, Percentage_of_All_Records DOUBLE",
    "top_cities": "City_State STRING, City STRING, State STRING, Accident_Count BIGINT, "
    "Average_Severity DOUBLE, Severity_3_4_Percentage DOUBLE",
    "year_summary": "Year INT, Accident_Count BIGINT, Average_Severity DOUBLE, "
    "Severity_3_4_Percentage DOUBLE",
    "weekday_summary": "Weekday_Number INT, Weekday STRING, Accident_Count BIGINT, "
    "Percentage_of_All_Records DOUBLE",
    "hour_summary": "Hour INT, Accident_Count BIGINT, Percentage_of_All_Records DOUBLE",
    "severity_distribution": "Severity INT, Accident_Count BIGINT, "
    "Percentage_of_All_Records DOUBLE",
    "weather_summary": "Weather_Condition_Group STRING, Accident_Count BIGINT, "
    "Average_Severity DOUBLE, Severity_3_4_Percentage DOUBLE, Percentage_of_All_Records DOUBLE",
    "road_feature_summary": "Feature STRING, Feature_Present BOOLEAN, Accident_Count BIGINT, "
    "Average_Severity DOUBLE, Severity_3_4_Percentage DOUBLE",
    "dimension_counts": "Dimension STRING, Value STRING, Accident_Count BIGINT",
    "run_table": "run INT, total_seconds DOUBLE, state_total BIGINT, year_total BIGINT, "
    "severity_total BIGINT, reconciliation_status STRING, output_uri STRING",
    "split_run_table": "run INT, input_rows BIGINT, valid_rows BIGINT, scan_and_aggregate_seconds DOUBLE, "
    "write_seconds DOUBLE, total_seconds DOUBLE, reconciliation_status STRING",
    "metrics": "metric STRING, value STRING",
}
