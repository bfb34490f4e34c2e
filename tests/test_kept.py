"""State that is kept between runs: counts per file, keys, partitions, sketches, footers."""

import glob
import os
import random
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from plans_helper import plan_of
from pyspark.sql import functions as F

from tallymill.operators.increments import PartialCounts
from tallymill.operators.known import KeyStore
from tallymill.operators.rows import dedup_by_key
from tallymill.operators.sketches import distinct_sketches, error_bound, estimated, united
from tallymill.plans import analysis_job, benchmark_counts, benchmark_job, benchmark_store, prepare_job, refresh_years
from tallymill.plans import jobs
from tallymill.sinks import rewrite_partitions, write_partitioned
from tallymill.sources.files import figures_frame, input_files, stored_figures
from tallymill.sources.readers import read_incidents_csv, read_summary_csv
from tallymill.workloads.standin import raw_incidents


def rows_of(frame):
    return sorted(map(str, frame.collect()))


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    """The raw records in five files."""
    path = str(tmp_path_factory.mktemp("kept") / "raw")
    raw_incidents(spark, sf_dir).repartition(5).write.option("header", True).csv(path)
    return path


# counts per file


def test_increments_read_new_files_alone(spark, raw, tmp_path):
    here, parts = tmp_path / "in", sorted(glob.glob(f"{raw}/*.csv"))
    here.mkdir()
    store = benchmark_store(spark, str(tmp_path / "store"))

    def full():
        return rows_of(jobs.combination_counts(jobs.benchmark_source(spark, str(here)), jobs.DIMENSIONS, where=jobs.benchmark_rule()))

    for part in parts[:2]:
        shutil.copy(part, here)
    assert len(store.add(str(here))) == 2 and rows_of(store.merged()) == full()
    assert store.add(str(here)) == []
    # A file that has been counted may turn into anything, as long as the listing says the same.
    old = here / os.path.basename(parts[0])
    seen, text = old.stat(), old.read_text()
    old.write_text("x" * seen.st_size)
    os.utime(old, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    for part in parts[2:]:
        shutil.copy(part, here)
    read = store.add(str(here))
    assert [os.path.basename(f) for f in read] == [os.path.basename(p) for p in parts[2:]]
    old.write_text(text)
    os.utime(old, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    assert rows_of(store.merged()) == full()
    assert rows_of(jobs.dimension_counts(store.merged(), jobs.DIMENSIONS)) == rows_of(benchmark_counts(spark, str(here)))
    # Changed: counted anew.  Gone: its counts stay.
    changed = here / os.path.basename(parts[1])
    changed.write_text("\n".join(changed.read_text().splitlines()[:20]))
    assert [os.path.basename(f) for f in store.add(str(here))] == [changed.name]
    want = full()
    assert rows_of(store.merged()) == want
    old.unlink()
    assert store.add(str(here)) == [] and rows_of(store.merged()) == want


def test_an_increment_that_died_counts_once(spark, raw, tmp_path):
    here, parts = tmp_path / "in", sorted(glob.glob(f"{raw}/*.csv"))
    here.mkdir()
    shutil.copy(parts[0], here)
    store = benchmark_store(spark, str(tmp_path / "store"))
    store.add(str(here))
    shutil.copy(parts[1], here)
    # Partial counts without an entry in the ledger.
    late = [f["file"] for f in store.pending(str(here)).collect()]
    store.count(late).write.parquet(f"{store.root}/partials/increment=2")
    before = store.merged().agg(F.sum("Input_Count")).first()[0]
    assert len(store.add(str(here))) == 1
    everything = read_incidents_csv(spark, str(here)).count()
    assert before < everything == store.merged().agg(F.sum("Input_Count")).first()[0]


def test_listing_and_file_column(spark, raw):
    listed = {os.path.basename(r["file"]): r["size"] for r in input_files(spark, raw).collect()}
    assert listed == {os.path.basename(p): os.path.getsize(p) for p in glob.glob(f"{raw}/*.csv")}
    named = read_incidents_csv(spark, raw, columns=["ID"], file_column="file")
    assert named.columns == ["ID", "file"] and named.select("file").distinct().count() == 5


def test_any_sums_can_be_kept(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    read = lambda files: spark.read.parquet(*files).groupBy(F.col("_metadata.file_path").alias("file"), (F.col("id") % 2).alias("odd")).agg(F.sum("id").alias("n"))
    store = PartialCounts(spark, str(tmp_path / "store"), ["odd"], ["n"], read)
    store.add(str(tmp_path / "in"))
    assert rows_of(store.merged()) == ["Row(odd=0, n=20)", "Row(odd=1, n=25)"]


# keys


def lines(spark, seed, n, batch):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(n)]), rng.randrange(3), f"{batch}-{rng.random():.4f}") for _ in range(n)]
    return spark.createDataFrame(rows, "a long, b int, v string")


def test_increments_equal_one_dedup(spark, tmp_path):
    batches = [lines(spark, s, 300, s) for s in range(3)]
    store = KeyStore(spark, "kept_lines", str(tmp_path), ["a", "b"], KeyStore.blocks_for(900), buckets=4)
    store.create(batches[0])
    for batch in batches[1:]:
        before = store.stored().count()
        assert store.add(batch).count() == store.stored().count() - before
    assert store.add(batches[1]).count() == 0
    every = [b.withColumn("batch", F.lit(i)) for i, b in enumerate(batches)]
    whole = every[0].unionByName(every[1]).unionByName(every[2]).where("a IS NOT NULL AND b IS NOT NULL")
    want = dedup_by_key(whole, ["a", "b"], ["batch", "v"]).drop("batch")
    assert rows_of(store.stored()) == rows_of(want)


def test_nothing_stored_is_shuffled(spark, tmp_path):
    store = KeyStore(spark, "kept_ids", str(tmp_path), ["id"], KeyStore.blocks_for(20000), buckets=4)
    store.create(spark.range(0, 20000, numPartitions=3))
    asked = spark.range(19000, 60000)
    passed = store.perhaps_known(asked)
    assert passed.where("id < 20000").count() == 1000
    assert passed.count() < 1000 + 41000 * 0.02
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = store.new_rows(asked)
        assert frame.count() == 40000
        plan = plan_of(frame)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    # Under each scan of a stored table and up to its join, no exchange: the line that reads it has none above it in its branch.
    found = 0
    lines_ = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
    for i, line in enumerate(lines_):
        if "FileScan" in line and "Bucketed: true" in line:
            found += 1
            level = depth(line)
            for above in reversed(lines_[:i]):
                if depth(above) < level:
                    level = depth(above)
                    assert "Exchange" not in above
                    if "Join" in above:
                        break
    assert found >= 2


# partitions


def test_other_partitions_keep_their_files(spark, tmp_path):
    path, folder = str(tmp_path / "data"), str(tmp_path / "folder")
    frame = spark.range(100).select("id", (F.col("id") % 4 + 2000).cast("int").alias("Year"))
    write_partitioned(frame, path)
    files = lambda: {os.path.relpath(f, path) for f in glob.glob(f"{path}/*/*.parquet")}
    before = files()
    # From the dataset itself: one year doubled, one emptied; rows of other years are not taken.
    stored = spark.read.parquet(path)
    new = stored.where("Year <> 2001").withColumn("id", F.col("id") * 2)
    rewrite_partitions(new, path, [2001, 2002], folder)
    kept = {f for f in before if f.startswith(("Year=2000", "Year=2003"))}
    after = files()
    assert kept <= after and not {f for f in after if f.startswith("Year=2001")}
    assert not {f for f in before if f.startswith("Year=2002")} & after
    got = {r["Year"]: (r["n"], r["s"]) for r in spark.read.parquet(path).groupBy("Year").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()}
    assert got == {2000: (25, 1200), 2002: (25, 2 * 1250), 2003: (25, 1275)}
    with pytest.raises(ValueError):
        write_partitioned(frame, path, replace="some")


def test_refresh_years(spark, raw, tmp_path):
    root = str(tmp_path)
    stored = prepare_job(spark, raw, root, checksums=True)
    check = read_summary_csv(spark, f"{root}/results/data_quality/content_check")
    assert [r["Status"] for r in check.collect()] == ["PASS"] * 3
    want = rows_of(stored)
    processed = f"{root}/processed/accidents_parquet"
    before = set(glob.glob(f"{processed}/*/*.parquet"))
    rewrite_partitions(stored.withColumn("Street", F.lit("stale")), processed, [1996], f"{root}/other")
    assert rows_of(spark.read.parquet(processed)) != want
    assert rows_of(refresh_years(spark, raw, root, [1996])) == want
    after = set(glob.glob(f"{processed}/*/*.parquet"))
    assert {f for f in before if "Year=1996" not in f} == {f for f in after if "Year=1996" not in f}


def test_staging_has_a_name_of_its_own(spark, raw, tmp_path):
    """A caller's folder named staging stays, and two jobs may share a root."""
    root = str(tmp_path)
    os.makedirs(f"{root}/staging")
    open(f"{root}/staging/mine", "w").close()
    stored = prepare_job(spark, raw, root)
    path = f"{root}/processed/accidents_parquet"
    with ThreadPoolExecutor(2) as pool:
        reports = pool.submit(analysis_job, spark, path, root, minimum_city_count=1)
        runs = pool.submit(benchmark_job, spark, raw, root, runs=1)
        reports.result()
        assert runs.result().count() == 1
    assert os.listdir(f"{root}/staging") == ["mine"] and glob.glob(f"{root}/staging-*") == []
    assert stored.count() > 0 and read_summary_csv(spark, f"{root}/city_severity_min_1").count() > 0


# sketches


def test_united_sketches(spark, tmp_path):
    frame = spark.range(60000).select((F.col("id") % 3).alias("part"), (F.col("id") % 20000).alias("value"))
    path = str(tmp_path / "sketches")
    nothing = spark.createDataFrame([(9, None)], "part long, value long")
    distinct_sketches(frame.unionByName(nothing), ["part"], "value").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.select(F.max(F.octet_length("sketch"))).first()[0] < 10000
    each = {r["part"]: r["distinct_estimate"] for r in estimated(united(stored, ["part"])).collect()}
    assert each[9] == 0 and set(each) == {0, 1, 2, 9}
    every = estimated(united(stored)).first()
    assert every["row_count"] == 60001
    assert abs(every["distinct_estimate"] - 20000) <= 20000 * error_bound()


# footers


def test_figures_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "data")
    frame = spark.range(0, 5000, numPartitions=2).select("id", F.when(F.col("id") % 5 > 0, F.col("id") / 2).alias("half"), F.lit("x").alias("text"))
    frame.write.option("compression", "none").parquet(path)
    setting = spark.conf.get("spark.sql.sources.useV1SourceList")
    want = {"row_count": 5000, "minimum_id": 0, "maximum_id": 4999, "minimum_half": 0.5, "maximum_half": 2499.5, "count_half": 4000}
    assert stored_figures(spark, path, ["id", "half"], ["half"]).asDict() == want
    for file in glob.glob(f"{path}/*.parquet"):  # data pages gone, footers whole
        data = bytearray(open(file, "rb").read())
        data[4:2000] = b"\xff" * 1996
        open(file, "wb").write(data)
        os.remove(f"{path}/.{os.path.basename(file)}.crc")
    assert stored_figures(spark, path, ["id", "half"], ["half"]).asDict() == want
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == setting
    with pytest.raises(Exception):  # noqa: B017 - the caller's session reads the pages
        figures_frame(spark, path, ["id"], []).collect()
