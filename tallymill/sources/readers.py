"""Readers.  Paths go to Spark unchanged, so any Hadoop file system URI works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import RAW_DDL, RESULT_DDL


def read_incidents_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    schema: str = RAW_DDL,
    columns: Sequence[str] | None = None,
    header: bool = True,
    mode: str = "PERMISSIVE",
    escape: str | None = None,
    multi_line: bool = False,
    enforce_schema: bool = True,
    file_column: str | None = None,
) -> DataFrame:
    """Raw CSV with a declared schema; no inference pass.

    ``columns`` projects at once, which the CSV parser uses to skip the cells of
    other columns.  A cell that does not fit its type becomes null.  With
    ``enforce_schema=False`` a header that differs from the schema fails the read
    instead of being mapped by position.  ``escape='"'`` reads doubled quotes and
    ``multi_line=True`` reads line breaks inside quotes; the latter makes files
    unsplittable, so it stays off unless the data needs it.  ``file_column`` adds the path of
    each row's file under that name.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", mode)
        .option("enforceSchema", enforce_schema)
        .option("multiLine", multi_line)
    )
    if escape is not None:
        reader = reader.option("escape", escape)
    frame = reader.csv(path)
    wanted = [F.col(f"`{name}`") for name in columns or frame.columns]
    if file_column is not None:
        return frame.select(*wanted, F.col("_metadata.file_path").alias(file_column))
    return frame.select(*wanted) if columns else frame


def read_parquet(spark: SparkSession, path: str, *, schema: str | None = None) -> DataFrame:
    """A Parquet dataset; partition directories such as ``Year=2020`` become columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_summary_csv(spark: SparkSession, path: str, *, layout: str | None = None) -> DataFrame:
    """A small result CSV.

    ``layout`` is a key of ``RESULT_DDL`` or a DDL string.  Without one the types
    are inferred, which costs one more pass over the (small) file.
    """
    reader = spark.read.option("header", True)
    if layout is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(RESULT_DDL.get(layout, layout)).csv(path)
