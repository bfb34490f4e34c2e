from .readers import read_incidents_csv, read_parquet, read_summary_csv
from .schema import (
    COUNT_COLUMNS,
    FLAG_COLUMNS,
    RAW_COLUMNS,
    RAW_DDL,
    RESULT_DDL,
    TIME_COLUMNS,
    WEATHER_MEASURES,
)

__all__ = [
    "COUNT_COLUMNS",
    "FLAG_COLUMNS",
    "RAW_COLUMNS",
    "RAW_DDL",
    "RESULT_DDL",
    "TIME_COLUMNS",
    "WEATHER_MEASURES",
    "read_incidents_csv",
    "read_parquet",
    "read_summary_csv",
]
