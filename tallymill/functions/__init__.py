from .labels import (
    fixed_point,
    millions_label,
    percent_label,
    readable,
    round_binary,
    safe_alias,
    thousands,
)
from .timestamps import (
    DATE_SHAPES,
    WEEKDAYS,
    parse_timestamp,
    parse_timestamp_mixed,
    time_parts,
    timestamp_text,
    weekday_name,
)

__all__ = [
    "DATE_SHAPES",
    "WEEKDAYS",
    "fixed_point",
    "millions_label",
    "parse_timestamp",
    "parse_timestamp_mixed",
    "percent_label",
    "readable",
    "round_binary",
    "safe_alias",
    "thousands",
    "time_parts",
    "timestamp_text",
    "weekday_name",
]
