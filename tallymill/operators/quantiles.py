"""Exact quantiles per group in bounded memory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.writers import staged

#: Rows of one bracket that the last pass may bring to a task.
FEW = 10_000
#: Cells that a bracket is cut into.
CELLS = 64


def exact_quantiles(
    frame: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Sequence[float],
    folder: str,
    *,
    few: int = FEW,
    cells: int = CELLS,
) -> DataFrame:
    """keys, row_count, share, quantile: interpolated between the two nearest ranks, as ``percentile`` does.

    ``percentile`` and ``median`` bring every different value of a group to one task.  Here each wanted rank has a
    bracket of values, at first the group's range.  A mergeable sketch of the rows inside cuts it into cells, a pass
    counts the rows of each cell, and the cell that holds the rank is the next bracket, so that each pass leaves about
    one row in ``cells``.  When a bracket holds at most ``few`` rows, or one value alone, its values are counted one by
    one and the rank is read off.  The counts are exact, so the sketch decides the number of passes and not the result.

    Tasks ship a sketch and some counts per bracket: what is shuffled depends on groups, not on rows.  The
    driver sees only whether a bracket is left.  Nulls and NaN do not enter; a null key is a group.  ``frame`` is read
    twice per pass and should be stored; small tables go to ``folder``.
    """
    number = F.col(f"`{value}`").cast("double")
    rows = frame.where(number.isNotNull() & ~F.isnan(number)).select(*keys, number.alias("_v"))
    groups = rows.groupBy(*keys).agg(F.count("*").alias("row_count"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    groups = staged(groups, f"{folder}/groups")
    at = F.col("share") * (F.col("row_count") - 1)
    asked = groups.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    ranks = asked.withColumn("_rank", F.explode(F.array(F.floor(at), F.ceil(at))))
    # The value of a rank (from 0) lies from _lo to _hi, which hold _inside rows, with _below rows under them.
    targets = ranks.select(*keys, "_rank", "_lo", "_hi", F.lit(0).cast("long").alias("_below"), F.col("row_count").alias("_inside"))
    targets = staged(targets.distinct(), f"{folder}/targets_0")
    open_ = (F.col("_lo") < F.col("_hi")) & (F.col("_inside") > few)
    passes = 0
    while not targets.where(open_).isEmpty():
        passes += 1
        narrowed = _narrowed(rows, keys, targets.where(open_), cells).unionByName(targets.where(~open_))
        targets = staged(narrowed, f"{folder}/targets_{passes}")
    single = targets.where("_lo = _hi").select(*keys, "_rank", F.col("_lo").alias("_value"))
    counted = _within(rows, keys, targets.where("_lo < _hi")).groupBy(*keys, "_lo", "_hi", "_v").agg(F.count("*").alias("_n"))
    read = _chosen(targets.where("_lo < _hi"), counted, keys, ["_v"]).select(*keys, "_rank", F.col("_v").alias("_value"))
    found = staged(single.unionByName(read), f"{folder}/values")
    low = found.withColumnsRenamed({"_rank": "_low", "_value": "_a"})
    high = found.withColumnsRenamed({"_rank": "_high", "_value": "_b"})
    asked = asked.drop("_lo", "_hi").withColumns({"_low": F.floor(at), "_high": F.ceil(at)})
    both = _meeting(_meeting(asked, low, [*keys, "_low"]), high, [*keys, "_high"])
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (at - F.col("_low"))
    quantile = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(between)
    return both.select(*keys, "row_count", "share", quantile.alias("quantile"))


def _meeting(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An inner equi-join in which null keys meet."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    test = F.lit(True)
    for key, name in names.items():
        test = test & F.col(key).eqNullSafe(F.col(name))
    return left.join(right.withColumnsRenamed(names), test).drop(*names.values())


def _within(rows: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """Each row with the bracket that holds it; ranks with one bracket in common read it once."""
    brackets = targets.select(*keys, "_lo", "_hi").distinct()
    return _meeting(rows, brackets, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _chosen(targets: DataFrame, counted: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """For each target the part of its bracket (n rows each, in ``order``) that holds its rank; _before rows precede it."""
    parts = Window.partitionBy(*keys, "_lo", "_hi").orderBy(*order)
    running = counted.withColumn("_before", F.sum("_n").over(parts) - F.col("_n"))
    met = _meeting(targets, running, [*keys, "_lo", "_hi"])
    place = F.col("_rank") - F.col("_below") - F.col("_before")
    return met.where((place >= 0) & (place < F.col("_n")))


def _narrowed(rows: DataFrame, keys: Sequence[str], targets: DataFrame, cells: int) -> DataFrame:
    """The targets with the cells that hold their ranks as brackets."""
    bracket = [*keys, "_lo", "_hi"]
    points = F.array(*[F.lit(i / cells) for i in range(cells + 1)])
    sketched = _within(rows, keys, targets).groupBy(*bracket).agg(F.kll_sketch_agg_double("_v").alias("_sketch"))
    cuts = sketched.select(*bracket, F.array_distinct(F.kll_sketch_get_quantile_double("_sketch", points)).alias("_cuts"))
    # A value that is a cut is a cell of its own, behind the values between the cut before and this one.
    cell = [
        F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_cell"),
        F.array_contains("_cuts", F.col("_v")).alias("_cut"),
    ]
    placed = _meeting(rows, cuts, keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    counted = placed.groupBy(*bracket, *cell).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    chosen = _chosen(targets, counted, keys, ["_cell", "_cut"])
    return chosen.select(
        *keys,
        "_rank",
        F.col("_least").alias("_lo"),
        F.col("_most").alias("_hi"),
        (F.col("_below") + F.col("_before")).alias("_below"),
        F.col("_n").alias("_inside"),
    )
