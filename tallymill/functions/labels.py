"""Number rounding and label text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def fixed_point(column: str | Column, digits: int) -> Column:
    """Text with ``digits`` decimals and no grouping.

    Rounds the stored binary value, half to even, as printf does;
    ``format_string`` would round the shortest decimal form half up instead.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", _column(column), F.lit(pattern))


def round_binary(column: str | Column, digits: int = 4) -> Column:
    """Round the stored binary value, half to even, to a double."""
    return fixed_point(column, digits).cast("double")


def thousands(column: str | Column) -> Column:
    """Whole number with thousands separators, e.g. ``7,728,394``."""
    return F.format_number(_column(column), 0)


def millions_label(column: str | Column) -> Column:
    """Millions with two decimals, e.g. ``0.41M``."""
    return F.concat(fixed_point(_column(column) / 1e6, 2), F.lit("M"))


def percent_label(column: str | Column, digits: int) -> Column:
    """Percentage with a percent sign, e.g. ``15.7%``."""
    return F.concat(fixed_point(column, digits), F.lit("%"))


def readable(column: str | Column) -> Column:
    """Underscores to blanks."""
    return F.replace(_column(column), F.lit("_"), F.lit(" "))


def safe_alias(name: str, prefix: str = "Mean_") -> str:
    """Column name without brackets or percent sign: ``Humidity(%)`` → ``Mean_Humidity_pct``."""
    return prefix + re.sub(r"[()%]", lambda m: {"(": "_", ")": "", "%": "pct"}[m.group()], name)
