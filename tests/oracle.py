"""Compare a Spark result with DuckDB's, independent of row order."""

from __future__ import annotations

import datetime
import math

import duckdb

# Spark type to the DuckDB types it stands for.
KINDS = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"},
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_frame, con, sql):
    """Empty when names, types, row counts and values agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _sorted_rows(names, cursor.fetchall())
    if sorted(spark_frame.columns) != sorted(names):
        return f"columns {sorted(spark_frame.columns)} != {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in spark_frame.dtypes:
        if kinds[name] not in KINDS[kind]:
            return f"{name} is {kind}, oracle has {kinds[name]}"
    actual = _sorted_rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, oracle has {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return ""
