"""Chart-ready tables: the rows, order and labels each chart shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import fixed_point, millions_label, percent_label, readable, thousands
from ..operators.flags import FEATURE, PRESENT
from ..operators.runs import side_by_side
from ..operators.summaries import COUNT, SHARE, top_ascending

# Years the source covers only in part, and the feature that is
# never present.
PARTIAL_YEARS = (2016, 2023)
ABSENT_FEATURES = ("Turning_Loop",)
HEADROOM = 1.18


def _top(summary: DataFrame, label: str, n: int) -> DataFrame:
    return top_ascending(summary.select(label, COUNT), label, n=n).withColumn(
        "Label", thousands(COUNT)
    )


def top_states(summary: DataFrame, n: int = 10) -> DataFrame:
    return _top(summary, "State", n)


def top_cities(summary: DataFrame, n: int = 10) -> DataFrame:
    return _top(summary, "City_State", n)


def yearly(summary: DataFrame, partial: Sequence[int] = PARTIAL_YEARS) -> DataFrame:
    """Year counts with a partial-coverage mark and a label in millions."""
    return summary.select(
        "Year",
        COUNT,
        F.col("Year").isin(*partial).alias("Is_Partial_Year"),
        millions_label(COUNT).alias("Label"),
    ).orderBy("Year")


def weekdays(summary: DataFrame) -> DataFrame:
    return summary.select(
        "Weekday_Number", "Weekday", COUNT, percent_label(SHARE, 1).alias("Label")
    ).orderBy("Weekday_Number")


def hourly(summary: DataFrame) -> DataFrame:
    return summary.select("Hour", COUNT).orderBy("Hour")


def severity_shares(summary: DataFrame) -> DataFrame:
    """Severity shares, their labels, and the axis limit above the largest share."""
    limit = summary.agg(F.max(SHARE) * HEADROOM).scalar()
    return summary.select(
        "Severity", SHARE, percent_label(SHARE, 2).alias("Label"), limit.alias("Axis_Limit")
    ).orderBy("Severity")


def top_weather(summary: DataFrame, n: int = 10, exclude: str = "Missing") -> DataFrame:
    label = "Weather_Condition_Group"
    return _top(summary.filter(F.col(label) != exclude), label, n)


def present_features(
    summary: DataFrame, exclude: Sequence[str] = ABSENT_FEATURES
) -> DataFrame:
    """Features where present, readable names, fewest rows first."""
    is_present = F.lower(F.col(PRESENT).cast("string")) == "true"
    return (
        summary.filter(is_present & ~F.col(FEATURE).isin(*exclude))
        .select(readable(FEATURE).alias(FEATURE), COUNT, thousands(COUNT).alias("Label"))
        .orderBy(COUNT, FEATURE)
    )


def runtimes(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two frameworks' seconds per run with two-place labels."""
    labels = {f"{name}_Label": fixed_point(name, 2) for name in names}
    return side_by_side(left, right, names=names).withColumns(labels).orderBy("run")
