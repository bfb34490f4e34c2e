"""One scan for all keyed reports.

Every keyed report is a sum over counts per key and severity.  Four grouping sets
hold all keys in use; their counts are small whatever the table's size, so the
reports run on them and the table is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.flags import flag_mask
from ..operators.summaries import COUNT, level_counts
from ..sources.schema import FLAG_COLUMNS

LEVEL = "Severity"

# The keys of each slice.
SLICES = {
    "place": ["City", "State"],
    "time": ["Year", "Month", "Weekday_Number", "Weekday", "Hour"],
    "weather": ["Weather_Condition_Group"],
    "feature": ["Feature_Mask"],
}


def report_base(
    cleaned: DataFrame,
    slices: Sequence[str] = tuple(SLICES),
    flags: Sequence[str] = tuple(FLAG_COLUMNS),
) -> DataFrame:
    """The columns the slices' reports use, with missing weather labelled and flags packed."""
    made = {
        "Weather_Condition_Group": lambda: F.coalesce("Weather_Condition", F.lit("Missing")),
        "Feature_Mask": lambda: flag_mask(flags),
    }
    keys = [key for name in slices for key in SLICES[name]]
    return cleaned.select(
        *[made[key]().alias(key) if key in made else F.col(key) for key in keys], LEVEL
    )


def base_counts(base: DataFrame, name: str) -> DataFrame:
    """Counts of one slice from the rows of ``report_base``."""
    return level_counts(base, SLICES[name], LEVEL)


def slice_counts(cleaned: DataFrame, name: str) -> DataFrame:
    """Counts of one slice straight from the cleaned rows."""
    return base_counts(report_base(cleaned, [name]), name)


def incident_rollup(base: DataFrame) -> DataFrame:
    """Counts of all slices in one scan of ``report_base``.

    Columns: Slice, the keys of all slices (null outside their own slice), the
    level and the count.
    """
    keys = [key for names in SLICES.values() for key in names]
    sets = [[F.col(key) for key in [*names, LEVEL]] for names in SLICES.values()]
    label = F.coalesce(
        *[F.when(F.grouping(names[0]) == 0, F.lit(name)) for name, names in SLICES.items()]
    )
    grouped = base.groupingSets(sets, *[F.col(key) for key in [*keys, LEVEL]])
    return grouped.agg(label.alias("Slice"), F.count("*").alias(COUNT)).select(
        "Slice", *keys, LEVEL, COUNT
    )


def rollup_slice(rollup: DataFrame, name: str) -> DataFrame:
    """Counts of one slice out of ``incident_rollup``."""
    return rollup.filter(F.col("Slice") == name).select(*SLICES[name], LEVEL, COUNT)
