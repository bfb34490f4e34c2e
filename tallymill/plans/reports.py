"""The analysis reports.

Each takes counts per key and severity (``level_counts``, ``slice_counts`` or
``rollup_slice``), so the same code serves a direct query and the one-scan rollup.
``total`` replaces the default grand total, the sum over the given counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checks import reconcile
from ..operators.flags import flag_summary
from ..operators.summaries import (
    COUNT,
    MEAN,
    RATE,
    SHARE,
    having_min,
    mean_columns,
    summarize,
    top_k,
)
from ..sources.schema import FLAG_COLUMNS, WEATHER_MEASURES


def severity_mean() -> dict[str, str]:
    return {MEAN: "Severity"}


def severe_rate() -> dict[str, Column]:
    return {RATE: F.col("Severity") >= 3}


def by_count(*labels: str) -> list:
    """Most rows first, ties by label."""
    return [F.desc(COUNT), *labels]


def by_mean(*labels: str) -> list:
    """Highest mean first, then most rows, then label."""
    return [F.desc(MEAN), F.desc(COUNT), *labels]


def state_summary(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    return summarize(
        counts,
        ["State"],
        mean=severity_mean(),
        rate=severe_rate(),
        share=SHARE,
        total=total,
        weight=COUNT,
        order=by_count("State"),
    )


def city_summary(counts: DataFrame) -> DataFrame:
    """Every city of a state, unordered."""
    named = counts.withColumn("City_State", F.concat_ws(", ", "City", "State"))
    return summarize(
        named,
        ["City_State", "City", "State"],
        mean=severity_mean(),
        rate=severe_rate(),
        weight=COUNT,
    )


def top_cities(counts: DataFrame, k: int = 100) -> DataFrame:
    return top_k(city_summary(counts), k, by_count("City_State"))


def city_severity(counts: DataFrame, minimum: int = 1000) -> DataFrame:
    """Cities with enough rows, ranked by mean severity."""
    return having_min(city_summary(counts), minimum).orderBy(*by_mean("City_State"))


def year_summary(counts: DataFrame) -> DataFrame:
    return summarize(
        counts, ["Year"], mean=severity_mean(), rate=severe_rate(), weight=COUNT, order=["Year"]
    )


def year_month_summary(counts: DataFrame) -> DataFrame:
    keys = ["Year", "Month"]
    return summarize(counts, keys, mean=severity_mean(), weight=COUNT, order=keys)


def weekday_summary(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    return summarize(
        counts,
        ["Weekday_Number", "Weekday"],
        share=SHARE,
        total=total,
        weight=COUNT,
        order=["Weekday_Number"],
    )


def hour_summary(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    return summarize(counts, ["Hour"], share=SHARE, total=total, weight=COUNT, order=["Hour"])


def weekday_hour_summary(counts: DataFrame) -> DataFrame:
    return summarize(
        counts,
        ["Weekday_Number", "Weekday", "Hour"],
        weight=COUNT,
        order=["Weekday_Number", "Hour"],
    )


def severity_distribution(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    return summarize(
        counts, ["Severity"], share=SHARE, total=total, weight=COUNT, order=["Severity"]
    )


def weather_summary(counts: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """By weather label; rows without one are the group ``Missing``."""
    return summarize(
        counts,
        ["Weather_Condition_Group"],
        mean=severity_mean(),
        rate=severe_rate(),
        share=SHARE,
        total=total,
        weight=COUNT,
        order=by_count("Weather_Condition_Group"),
    )


def numeric_weather(
    cleaned: DataFrame, columns: Sequence[str] = tuple(WEATHER_MEASURES)
) -> DataFrame:
    return mean_columns(cleaned, columns)


def road_feature_summary(
    counts: DataFrame, flags: Sequence[str] = tuple(FLAG_COLUMNS)
) -> DataFrame:
    return flag_summary(counts, flags, mean=severity_mean(), rate=severe_rate())


def reconciliation(
    total: DataFrame,
    *,
    state: DataFrame,
    year: DataFrame,
    severity: DataFrame,
    info: Mapping[str, str] | None = None,
) -> DataFrame:
    return reconcile(total, {"state": state, "year": year, "severity": severity}, info=info)
