"""Stored rows that are deduplicated and written without moving or sorting more of them than must be."""

import glob
import os
import random

import pytest
from plans_helper import plan_of
from pyspark.sql import functions as F

import tallymill.operators.rows as rows
import tallymill.sinks.writers as writers
from tallymill.plans import jobs
from tallymill.sinks import staged, write_partitioned
from tallymill.workloads.queries import QUERIES, _prepare_tables, _raw_csv
from tallymill.workloads.standin import cleaned_incidents, raw_incidents, typed_incidents


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def many(spark, n, seed=1):
    """Keys that repeat or are null, rows that tie on the first columns of the order, and equal rows."""
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    made = []
    for _ in range(n):
        made.append((pick(*range(n // 4)), pick("x", "y"), pick("a", "b"), pick(1, 2), pick(0.0, float("nan")), pick("p"), pick(*"uvwxyz")))
    made += made[: n // 10]
    return spark.createDataFrame(made, "`k 1` int, k2 string, a string, b int, `c(d)` double, e string, f string").repartition(5)


@pytest.mark.parametrize("order_by", [None, ["f", "e"], ["f", "a", "b", "c(d)", "e"]])
def test_stored_dedup_equals_the_plain_one(spark, tmp_path, order_by):
    frame = many(spark, 600)
    stored = staged(rows.numbered(frame), str(tmp_path / "in"))
    keys = ["k 1", "k2"]
    got = rows.dedup_stored(stored, keys, str(tmp_path / "one"), order_by)
    assert got.columns == frame.columns
    if order_by != ["f", "e"]:
        assert rows_of(got) == rows_of(rows.dedup_by_key(frame, keys, order_by))
    else:  # rows that tie on the whole order may differ
        first = lambda found: rows_of(found.select("`k 1`", "k2", "f", "e"))
        assert first(got) == first(rows.dedup_by_key(frame, keys, order_by))


def test_stored_dedup_of_keys_alone_and_of_nothing(spark, tmp_path):
    frame = many(spark, 200).select("k2", "a")
    stored = staged(rows.numbered(frame), str(tmp_path / "in"))
    assert rows_of(rows.dedup_stored(stored, ["k2", "a"], str(tmp_path / "one"))) == rows_of(frame.distinct())
    empty = stored.where("a = 'none'")
    assert rows.dedup_stored(empty, ["a"], str(tmp_path / "two")).count() == 0


def test_beyond_its_bound_stored_dedup_is_the_plain_one(spark, tmp_path, monkeypatch):
    frame = many(spark, 300)
    stored = staged(rows.numbered(frame), str(tmp_path / "in"))
    want = rows_of(rows.dedup_by_key(frame, ["k2", "f"]))
    monkeypatch.setattr(rows, "MOST_CHUNKS", 0)
    monkeypatch.setattr(rows, "_picked", None)
    assert rows_of(rows.dedup_stored(stored, ["k2", "f"], str(tmp_path / "one"))) == want


def test_whole_rows_are_not_exchanged(spark, tmp_path):
    """The last column is in no exchange, unless a key's rows tie on all that stands before it."""
    frame = spark.range(0, 4000, numPartitions=8).selectExpr("id % 1500 AS k", *[f"(id * 7 + {i}) % 4000 AS c{i}" for i in range(12)])
    stored = staged(rows.numbered(frame), str(tmp_path / "in"))
    found = rows.dedup_stored(stored, ["k"], str(tmp_path / "one"))
    plan = plan_of(found)
    assert "Window" not in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows_of(found) == rows_of(rows.dedup_by_key(frame, ["k"]))


@pytest.mark.parametrize("name", ["prepare_then_state_summary", "prepare_job_tables", "year_rewrite", "content_checks"])
def test_queries_that_store_rows_twice_move_few_whole_ones(spark, sf_dir, name, monkeypatch):
    """A dedup that exchanges whole rows took a large part of the disk these queries need."""
    whole = []
    plain = rows.dedup_by_key
    total = typed_incidents(spark, sf_dir).count()

    def seen(frame, *args, **kinds):
        whole.append(frame.count())
        return plain(frame, *args, **kinds)

    monkeypatch.setattr(rows, "dedup_by_key", seen)
    assert not QUERIES[name](spark, sf_dir).isEmpty()
    assert sum(whole) < total / 10


def test_prepare_with_and_without_a_stored_copy(spark, sf_dir, tmp_path):
    raw = str(tmp_path / "raw")
    raw_incidents(spark, sf_dir).write.option("header", True).csv(raw)
    one = jobs.prepare_job(spark, raw, str(tmp_path / "one"), checksums=True)
    two = jobs.prepare_job(spark, raw, str(tmp_path / "two"), stage=False)
    assert one.columns == two.columns and rows_of(one) == rows_of(two)
    tables = lambda at: {n: sorted(open(f).read() for f in glob.glob(f"{tmp_path}/{at}/results/data_quality/{n}/*.csv")) for n in ("summary", "missing_values")}
    assert tables("one") == tables("two") and tables("one")["summary"]


def test_wide_rows_are_read_in_slices(spark, tmp_path, monkeypatch):
    """A task of a partitioned write sorts what it reads; the session's limit of a scan may be more than it can hold."""
    path = str(tmp_path / "in")
    frame = spark.range(0, 6000, numPartitions=30).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 3).alias("Year"))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        whole = staged(frame, path, sliced=True)
        assert writers.read_slices(spark, path).rdd.getNumPartitions() == whole.rdd.getNumPartitions() == 1
        monkeypatch.setattr(writers, "SLICE_BYTES", 9000)
        wide = writers.read_slices(spark, path)
        sizes = [r["n"] for r in wide.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(sizes) > 5 and max(sizes) < 2000
    assert wide.schema == whole.schema and rows_of(wide) == rows_of(frame)
    write_partitioned(wide, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6000


def test_what_is_read_no_more_is_let_go(spark, sf_dir, tmp_path):
    root = str(tmp_path / "root")
    cleaned = cleaned_incidents(spark, sf_dir, root)
    assert os.listdir(root) == ["cleaned"]
    assert rows_of(cleaned) == rows_of(cleaned_incidents(spark, sf_dir)) == rows_of(writers.read_slices(spark, f"{root}/cleaned"))
    folder, raw = _raw_csv(spark, sf_dir)
    assert os.listdir(folder.removeprefix("file:")) == ["raw_csv"] and glob.glob(f"{raw}/part-*")


def test_merged_parts_are_let_go_one_by_one(spark, tmp_path, monkeypatch):
    """Of a partitioned write no value is stored twice for longer than it takes to merge it."""
    monkeypatch.setattr(writers, "WRITERS", 1)
    path, left = str(tmp_path / "d"), []
    merge = writers._merge

    def watched(*args):
        left.append(len(glob.glob(f"{path}/_parts-*/Year=*")))
        merge(*args)

    monkeypatch.setattr(writers, "_merge", watched)
    write_partitioned(spark.range(0, 100, numPartitions=4).select("id", (F.col("id") % 4).alias("Year")), path)
    assert left == [4, 3, 2, 1] and spark.read.parquet(path).count() == 100


def test_facts_hold_what_the_cells_name(spark, sf_dir, tmp_path):
    few = raw_incidents(spark, sf_dir, ["ID", "State", "Weather_Condition"], str(tmp_path / "few"))
    assert set(spark.read.parquet(str(tmp_path / "few/facts")).columns) == {"o_orderkey", "n_nationkey", "n_name", "event_type"}
    every = raw_incidents(spark, sf_dir, folder=str(tmp_path / "all"))
    assert not {"c_name", "user_id", "props"} & set(spark.read.parquet(str(tmp_path / "all/facts")).columns)
    assert rows_of(few) == rows_of(every.select(few.columns))


def test_the_raw_files_of_the_prepare_job_are_small(spark, sf_dir, monkeypatch):
    seen = []
    job = jobs.prepare_job
    monkeypatch.setattr(jobs, "prepare_job", lambda spark, raw, *a, **k: seen.extend(glob.glob(f"{raw}/part-*")) or job(spark, raw, *a, **k))
    _prepare_tables(spark, sf_dir)
    assert seen and all(name.endswith(".csv.gz") for name in seen)
