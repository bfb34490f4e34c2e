"""Staging that goes away, scans that are not repeated, files that stay few, hot keys that split."""

import glob
import os
import subprocess
import sys

import pytest
from plans_helper import plan_of
from pyspark.sql import functions as F
from test_plans import final

import tallymill.plans.jobs as jobs
from tallymill.operators import flag_counts, flag_summary, flag_summary_unpivot, profile, validation
from tallymill.operators.summaries import grouping_counts_sql
from tallymill.sinks import shared_folder, write_partitioned
from tallymill.sources.readers import read_incidents_csv
from tallymill.workloads import QUERIES
from tallymill.workloads.queries import _raw_csv
from tallymill.workloads.standin import raw_incidents, typed_incidents

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hygiene") / "raw")
    raw_incidents(spark, sf_dir).write.option("header", True).csv(path)
    return path


def left(root):
    return glob.glob(f"{root}/**/staging*", recursive=True)


def test_jobs_leave_no_staging(spark, raw, tmp_path):
    root = str(tmp_path)
    stored = jobs.prepare_job(spark, raw, f"{root}/out")
    assert stored.count() > 0
    jobs.analysis_job(spark, f"{root}/out/processed/accidents_parquet", f"{root}/a")
    jobs.analysis_job(spark, f"{root}/out/processed/accidents_parquet", f"{root}/b", one_scan=False)
    assert jobs.benchmark_job(spark, raw, f"{root}/c", runs=1).count() == 1
    assert jobs.split_benchmark_job(spark, raw, f"{root}/d", runs=1).count() == 1
    assert left(root) == []
    jobs.benchmark_job(spark, raw, f"{root}/e", runs=1, keep_staging=True)
    assert len(left(root)) == 1


@pytest.mark.parametrize("one_scan", [True, False])
def test_a_failed_job_leaves_neither_staging_nor_cache(spark, raw, tmp_path, monkeypatch, one_scan):
    root = str(tmp_path)
    jobs.prepare_job(spark, raw, f"{root}/out")

    def fail(*_, **__):
        raise RuntimeError("no room")

    monkeypatch.setattr(jobs, "write_csv", fail)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with pytest.raises(RuntimeError):
        jobs.analysis_job(spark, f"{root}/out/processed/accidents_parquet", f"{root}/a", one_scan=one_scan)
    with pytest.raises(RuntimeError):
        jobs.prepare_job(spark, raw, f"{root}/again")
    assert left(root) == []
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_shared_folder_sets_nothing(spark):
    before = spark.sparkContext.getCheckpointDir()
    shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() == before


def test_partitioned_write_keeps_files_few(spark, tmp_path):
    frame = spark.range(0, 4000, numPartitions=40).select("id", (F.col("id") % 5).alias("Year"))
    write_partitioned(frame, str(tmp_path / "few"))
    write_partitioned(frame, str(tmp_path / "many"), rebalance=False)
    files = lambda name: len(glob.glob(f"{tmp_path}/{name}/*/*.parquet"))
    assert files("few") <= 10 and files("many") == 200
    assert spark.read.parquet(str(tmp_path / "few")).count() == 4000


def test_partitioned_write_moves_no_rows_between_tasks(spark, tmp_path, monkeypatch):
    """Wide rows take several times their stored bytes in an exchange; small files are merged instead."""
    path = str(tmp_path / "d")
    frame = spark.range(0, 300, numPartitions=20).select(
        "id",
        F.when(F.col("id") % 3 < 2, F.concat(F.lit("a/b %="), F.col("id") % 3)).alias("place"),
        (F.col("id") % 2).cast("int").alias("Year"),
    )
    spark.range(1).withColumn("Year", F.lit(1950)).write.partitionBy("Year").parquet(path)
    for name in ("hint", "repartition", "repartitionByRange"):
        monkeypatch.setattr(type(frame), name, None)
    write_partitioned(frame, path, by=["Year", "place"])
    monkeypatch.undo()
    back = spark.read.parquet(path)
    assert back.exceptAll(frame.select(back.columns)).isEmpty() and back.count() == 300
    assert sorted(os.listdir(path))[-3:] == ["Year=0", "Year=1", "_SUCCESS"] and len(glob.glob(f"{path}/*/*/*.parquet")) == 6
    write_partitioned(back.where("Year = 1").limit(7), path, by=["Year", "place"], max_records_per_file=3)
    assert spark.read.parquet(path).count() == 7 and not os.path.exists(f"{path}/Year=0")
    write_partitioned(frame.limit(0), path)
    assert glob.glob(f"{path}/*") in ([], [f"{path}/_SUCCESS"])


def test_a_hot_order_is_split(spark, sf_dir, tmp_path):
    """Half of all lines belong to one order; event columns are read too."""
    for name in ("orders", "customer", "nation", "events"):
        os.symlink(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    many = lines.unionByName(lines).unionByName(lines).unionByName(lines)
    hot = F.when(F.xxhash64("l_partkey", "l_suppkey") % 2 == 0, F.lit(1)).otherwise(F.col("l_orderkey"))
    many.withColumn("l_orderkey", hot.cast("long")).repartition(8).write.parquet(str(tmp_path / "lineitem.parquet"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings if k != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = plan_of(raw_incidents(spark, str(tmp_path)))
    finally:
        for k in settings:
            spark.conf.unset(k)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in final(plan)


@pytest.mark.parametrize("name, table", [("label_texts", "orders"), ("city_summary_from_rows", "cleaned")])
def test_the_share_reads_its_rows_once(spark, sf_dir, name, table):
    plan = final(plan_of(QUERIES[name](spark, sf_dir)))
    assert "ReusedExchange" in plan and table in plan


@pytest.mark.parametrize("name", ["dimension_check", "benchmark_runs", "run_metrics", "five_way_check"])
def test_checks_read_stored_counts_alone(spark, sf_dir, name):
    plan = final(plan_of(QUERIES[name](spark, sf_dir)))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("/stored]" in line for line in scans)


def test_sql_counts_leave_no_view(spark):
    frame = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    counts = grouping_counts_sql(frame, ["a", "b"], view="counted_here")
    assert counts.count() == 3
    assert "counted_here" not in [t.name for t in spark.catalog.listTables()]


def test_more_flags_than_one_number_holds(spark):
    names = [f"f{i}" for i in range(130)]
    frame = spark.range(40).select(
        (F.col("id") % 4 + 1).cast("int").alias("Severity"),
        *[((F.col("id") * 7 + i) % (i + 2) == 0).alias(n) for i, n in enumerate(names)],
    )
    got = flag_summary(flag_counts(frame, names), names, mean={"m": "Severity"})
    want = flag_summary_unpivot(frame, names, mean={"m": "Severity"})
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_validation_leaves_a_sketch_out(spark):
    frame = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS ID", "2 AS Severity", "timestamp_ntz'2020-01-01' AS Start_Time"
    )
    low = profile(frame, approx=True).withColumn("distinct_id_count", F.lit(900).cast("long"))
    rows = {r[0]: r[1] for r in validation(low, frame, processed_uri="x").collect()}
    assert rows["status"] == "PASS"
    exact = profile(frame).withColumn("distinct_id_count", F.lit(900).cast("long"))
    assert {r[0]: r[1] for r in validation(exact, frame, processed_uri="x").collect()}["status"] == "FAIL"


def test_the_entry_works_without_the_optional_part():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("tallymill.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert len(names) > 60 and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(e.oracle_sql()) == names
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_times_of_a_wide_row_leave_methods_short_enough_to_compile(spark, sf_dir):
    """The JVM runs methods of 8,000 bytes of code and more interpreted, row after row."""
    typed = typed_incidents(spark, sf_dir)
    plan_of(typed)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$").__getattr__("MODULE$")
    made = debug.codegenStringSeq(typed._jdf.queryExecution().executedPlan())
    sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    assert sizes and all(size < 8000 for size in sizes), sizes


def test_raw_files_are_compressed(spark, sf_dir):
    """As text the raw records take several times the bytes of all else that a query writes."""
    _, raw = _raw_csv(spark, sf_dir)
    files = glob.glob(f"{raw}/part-*")
    assert files and all(name.endswith(".csv.snappy") for name in files)
    assert read_incidents_csv(spark, raw).exceptAll(raw_incidents(spark, sf_dir)).isEmpty()
