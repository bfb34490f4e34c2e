"""Row-level operators: one row per key, row rules, derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timestamps import parse_timestamp, time_parts
from ..sinks.writers import let_go, staged
from ..sources.schema import TIME_COLUMNS

#: The column that numbers the rows of a stored table.
ROW = "__row"
#: Columns of the order that travel with a key; rows that tie on them are compared whole.
LEAD = 4
#: Rows per bitmap of row numbers (Spark's hold so many), and bitmaps of 4 kB that may go to every executor.
CHUNK = 32768
MOST_CHUNKS = 1 << 16


def retype_times(
    frame: DataFrame, columns: Sequence[str] = tuple(TIME_COLUMNS), *, zoned: bool = False
) -> DataFrame:
    """Replace text timestamp columns by parsed ones, in place."""
    return frame.withColumns({name: parse_timestamp(name, zoned=zoned) for name in columns})


def dedup_by_key(
    frame: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep the first row of each key under ``order_by``, nulls last.

    By default all other columns take part in column order.  Rows that tie on the
    whole order are equal, so the result does not depend on how the input is
    split, nor on a task running twice.

    ``row_number() = 1`` becomes a group limit before and after the one exchange:
    each map task sends at most one row per key, so a key that fills a third of
    the table reaches its reducer as one row per map task.
    """
    if order_by is None:
        # rows of nothing but the key are equal
        order_by = [name for name in frame.columns if name not in set(keys)] or list(keys)
    ranking = [
        F.col(f"`{item}`").asc_nulls_last() if isinstance(item, str) else item for item in order_by
    ]
    window = Window.partitionBy(*[f"`{key}`" for key in keys]).orderBy(*ranking)
    ranked = frame.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def numbered(frame: DataFrame) -> DataFrame:
    """``frame`` with a number per row in ``ROW``; numbers hold once the rows are stored."""
    return frame.withColumn(ROW, F.monotonically_increasing_id())


def _picked(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """The stored rows of the given numbers, where they lie: a bit per row goes to them, no row moves."""
    number = F.col(ROW)
    chunk, bit = F.shiftrightunsigned(number, 15), number.bitwiseAND(CHUNK - 1)
    dealt = rows.select(chunk.alias("__chunk"), bit.alias("__bit")).repartition("__chunk")
    marks = dealt.groupBy("__chunk").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    met = stored.withColumn("__chunk", chunk).join(F.broadcast(marks), "__chunk")
    # Bit i of a bitmap is bit i % 8 of its byte i / 8.
    byte = F.conv(F.hex(F.substr("__bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.getbit(byte, (bit % 8).cast("int")) == 1
    return met.where(found).select(*[F.col(f"`{name}`") for name in stored.columns if name != ROW])


def dedup_stored(
    stored: DataFrame, keys: Sequence[str], folder: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``dedup_by_key`` over a stored, ``numbered`` table, without the numbers.

    Whole rows are neither sorted nor exchanged.  The key, the first ``LEAD`` columns of the order and the row number
    travel, at most two rows per key and map task; the numbers of the first rows then go to where these lie, as a
    bit per row.  Only the rows of keys whose first two rows tie on those columns are deduplicated as whole
    rows.  What goes to every executor is bounded: beyond ``MOST_CHUNKS`` bitmaps all is left to ``dedup_by_key``.
    The numbers are kept in ``folder``, where the result reads them.
    """
    whole = stored.drop(ROW)
    order = [name for name in whole.columns if name not in set(keys)] if order_by is None else list(order_by)
    lead = order[:LEAD]
    key = [F.col(f"`{name}`") for name in keys]
    window = Window.partitionBy(*key).orderBy(*[F.col(f"`{name}`").asc_nulls_last() for name in lead], ROW)
    narrow = stored.select(*[F.col(f"`{name}`") for name in dict.fromkeys([*keys, *lead])], ROW)
    two = narrow.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= 2)
    ties = F.lit(len(order) > len(lead)) & F.lead(ROW).over(window).isNotNull()
    for name in lead:
        ties = ties & F.lead(f"`{name}`").over(window).eqNullSafe(F.col(f"`{name}`"))
    first = two.withColumn("__ties", ties).filter(F.col("__rank") == 1)
    first = staged(first.select(ROW, F.when(F.col("__ties"), F.struct(*key)).alias("__tied")), f"{folder}/first", "zstd")
    let_go(stored.sparkSession)
    if first.select(F.shiftrightunsigned(ROW, 15)).distinct().count() > MOST_CHUNKS:
        return dedup_by_key(whole, keys, order_by)
    found = _picked(stored, first.filter(F.col("__tied").isNull()).select(ROW))
    tied = first.filter(F.col("__tied").isNotNull()).select(*[F.col(f"__tied.`{name}`").alias(f"__{i}") for i, name in enumerate(keys)])
    if tied.isEmpty():
        return found
    met = [F.col(f"`{name}`").eqNullSafe(F.col(f"__{i}")) for i, name in enumerate(keys)]
    others = stored.select(*key, ROW).join(tied, met, "left_semi").select(ROW)
    return found.unionByName(dedup_by_key(_picked(stored, others), keys, order_by))


def row_rule(
    not_null: Sequence[str] = (), between: Mapping[str, tuple[int, int]] | None = None
) -> Column:
    """The conjunction of the row rules as one predicate."""
    rule = F.lit(True)
    for name in not_null:
        rule = rule & F.col(f"`{name}`").isNotNull()
    for name, (low, high) in (between or {}).items():
        rule = rule & F.col(f"`{name}`").between(low, high)
    return rule


def apply_rules(
    frame: DataFrame,
    *,
    not_null: Sequence[str] = (),
    between: Mapping[str, tuple[int, int]] | None = None,
    fill: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep rows that meet every rule, then fill null labels."""
    kept = frame.filter(row_rule(not_null, between))
    if not fill:
        return kept
    return kept.withColumns(
        {name: F.coalesce(F.col(f"`{name}`"), F.lit(label)) for name, label in fill.items()}
    )


def derive(
    frame: DataFrame,
    *,
    time: str = "Start_Time",
    place: Sequence[str] = ("City", "State"),
    place_name: str = "City_State",
    level: str = "Severity",
    threshold: int = 3,
    flag_name: str = "Severity_3_4",
) -> DataFrame:
    """Add the joined place label, the calendar parts and the high-level 0/1 flag."""
    return frame.withColumns(
        {
            place_name: F.concat_ws(", ", *[F.col(name) for name in place]),
            **time_parts(time),
            flag_name: F.when(F.col(level) >= threshold, 1).otherwise(0),
        }
    )


# The cleaning rules.
CLEAN_NOT_NULL = ("ID", "Start_Time", "State")
CLEAN_BETWEEN = {"Severity": (1, 4)}
CLEAN_FILL = {"City": "Unknown"}


def clean_rows(typed: DataFrame) -> DataFrame:
    """Row rules and derived columns, without the dedup step."""
    return derive(
        apply_rules(typed, not_null=CLEAN_NOT_NULL, between=CLEAN_BETWEEN, fill=CLEAN_FILL)
    )


def clean(
    typed: DataFrame, *, order_by: Sequence[str | Column] | None = None, folder: str | None = None
) -> DataFrame:
    """The cleaned dataset: one row per ID first, row rules second.

    The order matters: when the kept copy breaks a rule, the ID goes.  Rows
    without an ID never survive, so they are dropped before the exchange.  With ``folder``, ``typed`` is a stored,
    ``numbered`` table and ``order_by`` has names only: ``dedup_stored`` finds the rows, and the exchange has no whole ones.
    """
    with_id = typed.filter(F.col("ID").isNotNull())
    if folder is not None:
        return clean_rows(dedup_stored(with_id, ["ID"], folder, order_by))
    return clean_rows(dedup_by_key(with_id, ["ID"], order_by))
