"""Timed runs: run tables, their summary, and runs of two frameworks side by side."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import metric_rows
from .checks import pass_fail
from .summaries import COUNT

DIMENSIONS = ("State", "Year", "Severity")


def timed(action: Callable[[], object]) -> float:
    """Wall-clock seconds of one action, to four places."""
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def _with_totals(
    counts: DataFrame, runs: DataFrame, dimensions: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    names = [f"{d.lower()}_total" for d in dimensions]
    totals = counts.groupBy("run").agg(
        *[
            F.sum(F.when(F.col("Dimension") == d, F.col(COUNT))).alias(name)
            for d, name in zip(dimensions, names)
        ]
    )
    return runs.join(totals, "run", "left"), names


def _all_equal(names: Sequence[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & (F.col(name) == F.col("expected_rows"))
    return pass_fail(test)


def run_table(
    counts: DataFrame, runs: DataFrame, *, dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """One row per run: seconds, total per dimension, PASS/FAIL, output.

    ``counts`` holds run, Dimension, Value, Accident_Count; ``runs`` holds run,
    total_seconds, expected_rows, output_uri.
    """
    joined, names = _with_totals(counts, runs, dimensions)
    return joined.select(
        "run",
        "total_seconds",
        *names,
        _all_equal(names).alias("reconciliation_status"),
        "output_uri",
    ).orderBy("run")


def run_metrics(
    counts: DataFrame, runs: DataFrame, *, dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """One row per run with input and valid rows, split seconds and five-way PASS/FAIL.

    ``runs`` holds run, input_rows, valid_rows, scan_and_aggregate_seconds,
    write_seconds and expected_rows.
    """
    joined, names = _with_totals(counts, runs, dimensions)
    parts = ["scan_and_aggregate_seconds", "write_seconds"]
    return joined.select(
        "run",
        "input_rows",
        "valid_rows",
        *[F.round(F.col(name), 4).alias(name) for name in parts],
        F.round(F.col(parts[0]) + F.col(parts[1]), 4).alias("total_seconds"),
        _all_equal(["input_rows", "valid_rows", *names]).alias("reconciliation_status"),
    ).orderBy("run")


def run_facts(
    runs: DataFrame,
    *,
    before: Mapping[str, object] | None = None,
    after: Mapping[str, object] | None = None,
    seconds: Sequence[str] = ("total_seconds",),
) -> DataFrame:
    """One row: number of runs, median seconds, whether all reconciled.

    ``before`` and ``after`` are given facts placed around the computed ones; a
    list becomes an array.
    """

    def given(facts: Mapping[str, object] | None) -> list[Column]:
        cells = []
        for name, fact in (facts or {}).items():
            many = isinstance(fact, (list, tuple))
            cell = F.array(*[F.lit(item) for item in fact]) if many else F.lit(fact)
            cells.append(cell.alias(name))
        return cells

    row = runs.agg(
        F.count("*").alias("runs"),
        *[F.round(F.median(name), 4).alias(f"median_{name}") for name in seconds],
        F.bool_and(F.col("reconciliation_status") == "PASS").alias("all_runs_reconciled"),
    )
    return row.select(*given(before), "*", *given(after))


def run_summary(runs: DataFrame, **facts) -> DataFrame:
    """(metric, value) rows of ``run_facts``."""
    return metric_rows(run_facts(runs, **facts))


def side_by_side(
    left: DataFrame,
    right: DataFrame,
    *,
    names: tuple[str, str] = ("Pandas", "PySpark"),
    on: str = "run",
    value: str = "total_seconds",
) -> DataFrame:
    """Runtimes of two run tables joined on the run number."""
    a = left.select(on, F.col(value).alias(names[0]))
    b = right.select(on, F.col(value).alias(names[1]))
    return a.join(b, on, "inner").orderBy(on)
