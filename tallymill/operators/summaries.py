"""Grouped summaries, rankings and grouping-set counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import safe_alias

COUNT = "Accident_Count"
INPUT = "Input_Count"
MEAN = "Average_Severity"
RATE = "Severity_3_4_Percentage"
SHARE = "Percentage_of_All_Records"


def level_counts(
    frame: DataFrame, keys: Sequence[str | Column], level: str = "Severity"
) -> DataFrame:
    """Rows per key and level value: a compact stand-in for the rows themselves.

    With few level values this loses nothing that ``summarize`` needs.  It holds
    one count only, so a report and the grand total it divides by plan the same
    first exchange, which Spark then runs once.
    """
    return frame.groupBy(*keys, level).agg(F.count("*").alias(COUNT))


def summarize(
    frame: DataFrame,
    keys: Sequence[str | Column],
    *,
    mean: Mapping[str, str | Column] | None = None,
    rate: Mapping[str, Column] | None = None,
    share: str | None = None,
    total: DataFrame | None = None,
    weight: str | None = None,
    count: str = COUNT,
    digits: int = 4,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Count, rounded means, rates in percent and share of total per key.

    ``mean`` and ``rate`` map output names to a numeric and a yes/no column; nulls
    do not enter a mean or rate.  ``weight`` names a count column when ``frame``
    holds pre-counted rows (``level_counts``).  ``share`` names the share-of-total
    column; ``total`` is a one-row frame, by default the total over ``frame``.  It
    joins in as a scalar subquery, inside the same job.
    """
    rows = F.count("*") if weight is None else F.sum(weight)

    def average(value: Column) -> Column:
        if weight is None:
            return F.avg(value)
        present = F.when(value.isNotNull(), F.col(weight))
        return F.try_divide(F.sum(value * F.col(weight)), F.sum(present))

    measures = [rows.alias(count)]
    for name, column in (mean or {}).items():
        value = F.col(column) if isinstance(column, str) else column
        measures.append(F.round(average(value), digits).alias(name))
    for name, condition in (rate or {}).items():
        measures.append(F.round(average(condition.cast("int")) * 100, digits).alias(name))
    result = frame.groupBy(*keys).agg(*measures)
    if share:
        if total is not None:
            grand = total
        elif weight is not None:
            grand = frame.agg(rows)
        else:
            # Over the groups themselves.  Every measure takes part, with factor 0, so that the
            # subquery plans the same first exchange, which Spark then runs once.
            every = F.max(F.hash(*[F.col(f"`{name}`") for name in result.columns])) * 0
            grand = result.agg(F.sum(count) + F.coalesce(every, F.lit(0)))
        percentage = F.try_divide(F.col(count) * 100, grand.scalar())
        result = result.withColumn(share, F.round(percentage, digits))
    return result.orderBy(*order) if order else result


def having_min(summary: DataFrame, minimum: int, count: str = COUNT) -> DataFrame:
    """Keep groups with at least ``minimum`` rows."""
    return summary.filter(F.col(count) >= minimum)


def top_k(summary: DataFrame, k: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``k`` rows under ``order``; each task keeps ``k``, one merges them."""
    return summary.orderBy(*order).limit(k)


def top_ascending(summary: DataFrame, label: str, value: str = COUNT, n: int = 10) -> DataFrame:
    """The ``n`` largest values, shown from smallest to largest; ties go by label."""
    return top_k(summary, n, [F.desc(value), label]).orderBy(value, label)


def mean_columns(
    frame: DataFrame, columns: Sequence[str], *, prefix: str = "Mean_", digits: int = 4
) -> DataFrame:
    """One row with the rounded mean of each column."""
    return frame.agg(
        *[
            F.round(F.avg(F.col(f"`{name}`")), digits).alias(safe_alias(name, prefix))
            for name in columns
        ]
    )


def value_counts(frame: DataFrame, column: str, count: str = COUNT) -> DataFrame:
    """Rows per value of one column."""
    return frame.groupBy(column).agg(F.count("*").alias(count))


def combination_counts(
    frame: DataFrame, keys: Sequence[str], *, where: Column | None = None
) -> DataFrame:
    """Rows per combination of keys: all of them (Input_Count) and those that meet ``where``.

    The condition is counted, not filtered on: a filter on a computed key moves
    below the projection, which then computes the key twice.
    """
    chosen = F.count("*") if where is None else F.count_if(where)
    return frame.groupBy(*keys).agg(F.count("*").alias(INPUT), chosen.alias(COUNT))


def dimension_counts(
    counted: DataFrame, dimensions: Sequence[str], *, extra_keys: Sequence[str] = ()
) -> DataFrame:
    """Dimension, Value (as text), Accident_Count per value of each dimension.

    ``counted`` holds the dimensions and a count, as ``combination_counts`` gives.
    """
    keys = [*extra_keys, *dimensions]
    sets = [[F.col(k) for k in (*extra_keys, name)] for name in dimensions]
    inside = {name: F.grouping(name) == 0 for name in dimensions}
    label = F.coalesce(*[F.when(test, F.lit(name)) for name, test in inside.items()])
    value = F.coalesce(*[F.when(test, F.col(n).cast("string")) for n, test in inside.items()])
    return (
        counted.filter(F.col(COUNT) > 0)
        .groupingSets(sets, *[F.col(k) for k in keys])
        .agg(label.alias("Dimension"), value.alias("Value"), F.sum(COUNT).alias(COUNT))
        .select(*extra_keys, "Dimension", "Value", COUNT)
    )


def grouping_counts(
    frame: DataFrame,
    dimensions: Sequence[str],
    *,
    where: Column | None = None,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Counts per value of each dimension over the rows that meet ``where``, from one scan.

    Grouping sets repeat their input once per dimension, so they run over the
    counts of the dimension combinations instead of the rows.  For dimensions whose
    combinations are nearly as many as the rows, use ``grouping_counts_sql``.
    """
    counted = combination_counts(frame, [*extra_keys, *dimensions], where=where)
    return dimension_counts(counted, dimensions, extra_keys=extra_keys)


def grouping_counts_sql(frame: DataFrame, dimensions: Sequence[str], *, view: str) -> DataFrame:
    """The same counts as a SQL text, straight from the rows.

    ``view`` is the frame's name in the statement; it is gone when this returns.
    """
    names = " ".join(f"WHEN grouping(`{d}`) = 0 THEN '{d}'" for d in dimensions)
    values = ", ".join(f"CAST(`{d}` AS STRING)" for d in dimensions)
    sets = ", ".join(f"(`{d}`)" for d in dimensions)
    frame.createOrReplaceTempView(view)
    try:
        return frame.sparkSession.sql(
            f"SELECT CASE {names} END AS Dimension, coalesce({values}) AS Value, "
            f"count(*) AS {COUNT} FROM {view} GROUP BY GROUPING SETS ({sets})"
        )
    finally:
        frame.sparkSession.catalog.dropTempView(view)


def dimension_table(
    counts: DataFrame, dimension: str, *, kind: str = "string", by_count: bool = False
) -> DataFrame:
    """One dimension of ``grouping_counts`` as its own table."""
    table = counts.filter(F.col("Dimension") == dimension).select(
        F.col("Value").cast(kind).alias(dimension), COUNT
    )
    return table.orderBy(F.desc(COUNT), dimension) if by_count else table.orderBy(dimension)
