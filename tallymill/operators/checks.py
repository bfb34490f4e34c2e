"""Reconciliation: totals that are really compared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .summaries import COUNT


def pass_fail(test: Column) -> Column:
    """PASS when the test holds, FAIL when it does not or is unknown."""
    return F.when(test, "PASS").otherwise("FAIL")


def _check_rows(row: DataFrame, entries: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    structs = [
        F.struct(
            F.lit(name).alias("Check"), value.cast("string").alias("Value"), status.alias("Status")
        )
        for name, value, status in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def reconcile(
    total: DataFrame,
    summaries: Mapping[str, DataFrame],
    *,
    info: Mapping[str, str] | None = None,
    count: str = COUNT,
) -> DataFrame:
    """Check, Value, Status: each summary's grand count against the input count.

    ``total`` is a one-row, one-column frame.  Every sum is a scalar subquery of
    the one plan.  ``info`` rows carry a text and the status INFO.
    """
    sums = {
        name: F.coalesce(summary.agg(F.sum(count)).scalar(), F.lit(0)).cast("bigint")
        for name, summary in summaries.items()
    }
    row = total.toDF("input_rows").select("input_rows", *[c.alias(n) for n, c in sums.items()])
    expected = F.col("input_rows")
    entries = [("input_row_count", expected, pass_fail(expected >= 0))]
    entries += [(f"{n}_count_sum", F.col(n), pass_fail(F.col(n) == expected)) for n in sums]
    entries += [(name, F.lit(text), F.lit("INFO")) for name, text in (info or {}).items()]
    return _check_rows(row, entries)


def dimension_check(
    counts: DataFrame, expected: DataFrame, dimensions: Sequence[str]
) -> DataFrame:
    """Dimension, Total, Expected, Status for each dimension, present or not."""
    totals = counts.agg(
        *[F.sum(F.when(F.col("Dimension") == d, F.col(COUNT))).alias(d) for d in dimensions]
    )
    row = totals.withColumn("Expected", expected.scalar())
    structs = [
        F.struct(
            F.lit(d).alias("Dimension"),
            F.coalesce(F.col(d), F.lit(0)).alias("Total"),
            F.col("Expected"),
            pass_fail(F.col(d) == F.col("Expected")).alias("Status"),
        )
        for d in dimensions
    ]
    return row.select(F.inline(F.array(*structs)))


def content_checksum(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """row_count, hash_sum, hash_xor: figures that do not depend on the order or the files of the rows.

    Each row is hashed over all its cells, with a text that tells which are null, since null cells leave a hash
    as it is.  Sum and xor of the hashes combine in the map tasks.  Columns are taken by name, in sorted order, so that their
    order does not matter either.  Rows that stand there several times count as often; xor alone would lose pairs of them.
    """
    names = sorted(frame.columns if columns is None else columns)
    cells = [F.col(f"`{name}`") for name in names]
    nulls = F.concat(*[F.when(cell.isNull(), "1").otherwise("0") for cell in cells])
    hashed = F.xxhash64(*cells, nulls)
    return frame.agg(
        F.count("*").alias("row_count"),
        F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor(hashed), F.lit(0)).cast("long").alias("hash_xor"),
    )


def compare_contents(expected: DataFrame, actual: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Check, Expected, Actual, Status of the figures of two frames that should hold the same rows."""
    names = ["row_count", "hash_sum", "hash_xor"]
    want = content_checksum(expected, columns).select(F.struct(*names).alias("want"))
    got = content_checksum(actual, columns).select(F.struct(*names).alias("got"))
    structs = [
        F.struct(
            F.lit(name).alias("Check"),
            F.col("want")[name].cast("string").alias("Expected"),
            F.col("got")[name].cast("string").alias("Actual"),
            pass_fail(F.col("want")[name] == F.col("got")[name]).alias("Status"),
        )
        for name in names
    ]
    return want.withColumn("got", got.scalar()).select(F.inline(F.array(*structs)))


def input_counts(frame: DataFrame, valid: Column) -> DataFrame:
    """input_rows and valid_rows in one pass."""
    return frame.agg(F.count("*").alias("input_rows"), F.count_if(valid).alias("valid_rows"))


def five_way_check(
    frame: DataFrame, valid: Column, counts: DataFrame, expected: DataFrame | None = None
) -> DataFrame:
    """``five_way_counts`` of the rows of ``frame``, which are read for it."""
    return five_way_counts(input_counts(frame, valid), counts, expected)


def five_way_counts(
    seen: DataFrame, counts: DataFrame, expected: DataFrame | None = None
) -> DataFrame:
    """Input, valid, state, year and severity totals against one expected count.

    ``seen`` is one row with input_rows and valid_rows; ``expected`` is a one-row frame, by
    default the input count itself.
    """
    dimensions = ("State", "Year", "Severity")
    sums = counts.agg(
        *[F.sum(F.when(F.col("Dimension") == d, F.col(COUNT))).alias(d) for d in dimensions]
    )
    row = seen.withColumns(
        {f"{d.lower()}_total": F.coalesce(sums.select(d).scalar(), F.lit(0)) for d in dimensions}
    )
    goal = F.col("input_rows") if expected is None else expected.scalar()
    row = row.withColumn("expected_rows", goal)
    names = ["input_rows", "valid_rows", *[f"{d.lower()}_total" for d in dimensions]]
    return _check_rows(
        row, [(n, F.col(n), pass_fail(F.col(n) == F.col("expected_rows"))) for n in names]
    )
