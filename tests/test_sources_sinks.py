"""CSV cell rules, partition discovery, writers and metric tables."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymill.sinks import (
    metric_rows,
    shared_folder,
    staged,
    write_csv,
    write_json,
    write_partitioned,
)
from tallymill.sources import (
    FLAG_COLUMNS,
    RAW_COLUMNS,
    read_incidents_csv,
    read_parquet,
    read_summary_csv,
)

DDL = "ID STRING, Sev INT, Flag BOOLEAN, Desc STRING, T STRING"


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_raw_layout():
    assert len(RAW_COLUMNS) == 46 and len(FLAG_COLUMNS) == 13
    assert RAW_COLUMNS[0] == "ID" and RAW_COLUMNS[-1] == "Astronomical_Twilight"


def test_permissive_cells(spark, tmp_path):
    path = write_lines(
        tmp_path / "a.csv",
        ["ID,Sev,Flag,Desc,T", '1,2,True,"a, b",x', "4,,true,,w", "5,2,TRUE", "6,2,yes,d,e,f", "7,zz,,d,e"],
    )
    got = {r[0]: tuple(r)[1:] for r in read_incidents_csv(spark, path, schema=DDL).collect()}
    assert got == {
        "1": (2, True, "a, b", "x"),
        "4": (None, True, None, "w"),
        "5": (2, True, None, None),
        "6": (2, None, "d", "e"),
        "7": (None, None, "d", "e"),
    }


def test_quotes_and_line_breaks_are_options(spark, tmp_path):
    path = write_lines(
        tmp_path / "q.csv", ["ID,Sev,Flag,Desc,T", '2,1,,"say ""hi"", ok",y', '3,3,,"multi', 'line",z']
    )
    options = {"escape": '"', "multi_line": True}
    rows = read_incidents_csv(spark, path, schema=DDL, **options).orderBy("ID").collect()
    assert [(r.ID, r.Desc, r["T"]) for r in rows] == [("2", 'say "hi", ok', "y"), ("3", "multi\nline", "z")]
    assert read_incidents_csv(spark, path, schema=DDL).count() == 3


def test_header_check_is_an_option(spark, tmp_path):
    path = write_lines(tmp_path / "h.csv", ["Sev,ID,Flag,Desc,T", "1,2,true,d,t"])
    assert read_incidents_csv(spark, path, schema=DDL).first().ID == "1"
    with pytest.raises(Exception, match="(?i)header"):
        read_incidents_csv(spark, path, schema=DDL, enforce_schema=False).collect()


def test_columns_prune_the_parser(spark, tmp_path):
    path = write_lines(tmp_path / "p.csv", ["ID,Sev,Flag,Desc,T", "1,2,true,d,t"])
    frame = read_incidents_csv(spark, path, schema=DDL, columns=["Sev"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Sev:int>" in plan and frame.columns == ["Sev"]


def test_missing_path(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_parquet(spark, "/nonexistent/data")


def test_partitioned_parquet_roundtrip(spark, tmp_path):
    path = str(tmp_path / "d")
    frame = spark.range(1000).select(
        "id", F.when(F.col("id") < 700, 2016).otherwise(2017).alias("Year"), F.lit(1.5).alias("Temp(F)")
    )
    for rebalance in (False, True):
        write_partitioned(frame, path, rebalance=rebalance)
        back = read_parquet(spark, path)
        assert back.columns == ["id", "Temp(F)", "Year"]
        assert dict(back.dtypes)["Year"] == "int"
        assert back.exceptAll(frame.select(back.columns)).count() == 0 and back.count() == 1000
    pruned = back.filter("Year = 2017")
    assert "PartitionFilters: [isnotnull(Year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 300


def test_csv_order_and_number_text(spark, tmp_path):
    path = str(tmp_path / "o")
    frame = spark.createDataFrame([("a", 1, 0.0008), ("b", 3, 2.0), ("c", 3, 0.5)], "k string, n int, v double")
    write_csv(frame, path, order=[F.desc("n"), "k"])
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    text = open(f"{path}/{parts[0]}", encoding="utf-8").read()
    assert text == "k,n,v\nb,3,2.0\nc,3,0.5\na,1,8.0E-4\n"
    inferred = read_summary_csv(spark, path)
    assert inferred.dtypes == [("k", "string"), ("n", "int"), ("v", "double")]
    write_csv(frame, path, order=["k"], partitions=2)
    assert read_summary_csv(spark, path, layout="k STRING, n INT, v DOUBLE").count() == 3


def test_metric_rows(spark):
    row = spark.range(1).select(
        F.lit(3).alias("n"),
        F.lit(True).alias("ok"),
        F.lit("x").alias("s"),
        F.array(F.lit("a"), F.lit("b")).alias("list"),
        F.create_map(F.lit("k"), F.lit(1)).alias("map"),
        F.lit(15.4447).alias("sec"),
    )
    assert [tuple(r) for r in metric_rows(row).collect()] == [
        ("n", "3"),
        ("ok", "true"),
        ("s", "x"),
        ("list", '["a","b"]'),
        ("map", '{"k":1}'),
        ("sec", "15.4447"),
    ]


def test_shared_folder_and_staging(spark):
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert staged(spark.range(5), first).count() == 5
    write_json(spark.range(1).select(F.lit(1).alias("run")), second)
    assert spark.read.json(second).first().run == 1
