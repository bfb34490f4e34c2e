"""Malformed CSV records set apart, with the cells that are at fault."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import staged
from .schema import RAW_DDL

RECORD = "_corrupt_record"


@dataclass(frozen=True)
class Quarantine:
    """``good`` records typed as declared; ``bad`` ones as record, bad_columns, wrong_length; ``columns`` counts them."""

    good: DataFrame
    bad: DataFrame
    columns: DataFrame


def read_quarantined(
    spark: SparkSession, path: str | list[str], folder: str, *, schema: str = RAW_DDL, escape: str | None = None, header: bool = True
) -> Quarantine:
    """CSV with a declared schema, in which no cell turns null unseen.

    A record is bad if a cell does not fit its column's type or the number of cells is wrong.  The parser marks such
    records while it reads, so good ones cost nothing more; only bad ones are cut into cells once more, as
    texts: a cell that holds a text there and null here is at fault.  The typed records are stored in ``folder`` first, since
    the mark is known only where all columns are parsed.  ``columns`` holds column, bad_records for each column at fault, and
    null as the column for records of a wrong length.
    """
    declared = spark.createDataFrame([], schema).schema
    reader = spark.read.schema(f"{schema}, `{RECORD}` STRING").option("header", header).option("mode", "PERMISSIVE")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    if escape is not None:
        options["escape"] = escape
    typed = staged(reader.options(**options).csv(path), f"{folder}/typed")
    names = [f.name for f in declared.fields]
    texts = ", ".join(f"`{n}` STRING" for n in [*names, RECORD])
    cells = F.from_csv(RECORD, texts, options)
    faults = F.array_compact(
        F.array(*[F.when(F.col("_cells").getField(n).isNotNull() & F.col(f"`{n}`").isNull(), F.lit(n)) for n in names])
    )
    marked = typed.where(F.col(RECORD).isNotNull()).withColumn("_cells", cells)
    bad = marked.select(
        F.col(RECORD).alias("record"), faults.alias("bad_columns"), F.col("_cells").getField(RECORD).isNotNull().alias("wrong_length")
    )
    bad = staged(bad, f"{folder}/bad")
    at_fault = F.concat("bad_columns", F.when(F.col("wrong_length"), F.array(F.lit(None).cast("string"))).otherwise(F.array()))
    columns = bad.select(F.explode(at_fault).alias("column")).groupBy("column").agg(F.count("*").alias("bad_records"))
    return Quarantine(typed.where(F.col(RECORD).isNull()).drop(RECORD), bad, columns)
