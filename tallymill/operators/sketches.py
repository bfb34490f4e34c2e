"""Distinct counts that can be stored and united."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch are 2**LG_REGISTERS bytes.
LG_REGISTERS = 12


def error_bound(lg_registers: int = LG_REGISTERS, deviations: float = 4.0) -> float:
    """Relative error of a united sketch that one in some 16,000 estimates exceeds."""
    return deviations * 1.04 / math.sqrt(1 << lg_registers)


def distinct_sketches(
    frame: DataFrame, keys: Sequence[str], column: str | Column, *, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """keys, row_count, sketch: a HyperLogLog sketch of a column per key, a few kB whatever the rows.

    Sketches combine in the map tasks.  Nulls do not enter; a key without any value has an empty sketch.
    """
    value = F.col(column) if isinstance(column, str) else column
    return frame.groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.hll_sketch_agg(value, F.lit(lg_registers)).alias("sketch")
    )


def united(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stored sketches united per key, or all of them; values that several hold count once."""
    return sketches.groupBy(*keys).agg(F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct_estimate") -> DataFrame:
    """The sketches replaced by what they estimate."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def within(estimate: str | Column, exact: str | Column, bound: float) -> Column:
    """Whether an estimate is within a relative bound of the exact count, to the nearest whole number."""
    estimate, exact = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(estimate - exact) <= F.ceil(exact * F.lit(bound))
