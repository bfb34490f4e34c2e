"""Writers for small result tables and for the row-level dataset."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(
    frame: DataFrame,
    path: str,
    *,
    order: Sequence[str | Column] = (),
    partitions: int = 1,
) -> None:
    """Write a result table as headed CSV, replacing what is there.

    The rows are exchanged into ``partitions`` files *after* the query's own last
    stage.  (Coalescing instead would pull that stage, with every map task's
    partial rows, into one task.)  With ``order`` each file is sorted, and several
    files follow one another by range.
    """
    if order and partitions > 1:
        frame = frame.repartitionByRange(partitions, *order)
    else:
        frame = frame.repartition(partitions)
    if order:
        frame = frame.sortWithinPartitions(*order)
    frame.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(
    frame: DataFrame,
    path: str,
    *,
    by: Sequence[str] = ("Year",),
    rebalance: bool = True,
    max_records_per_file: int | None = None,
    replace: str = "all",
) -> None:
    """Write Parquet under ``by=value`` directories, replacing what is there.

    ``replace="all"`` replaces the dataset; ``"present"`` only the directories that ``frame`` has rows for, and leaves
    the files of the others as they are.

    The files are kept few: tasks write as they are into a hidden folder, then each value's small files
    are read again and written as files of about ``FILE_BYTES``, without a shuffle.  Parquet holds rows by column, so
    both writes take fewer bytes than an exchange of wide rows does.  With ``rebalance=False`` what the tasks write is left, up
    to a file per task and value.  A plain repartition by value would send each value to one task, so it is not offered.
    """
    if replace not in ("all", "present"):
        raise ValueError("replace: all or present")
    spark = frame.sparkSession
    if rebalance:
        path = path.rstrip("/")
        parts = f"{path}/_parts-{uuid.uuid4().hex}"
        try:
            frame.write.options(**PARQUET).partitionBy(*by).parquet(parts)
            let_go(spark)
            found = _directories(spark, parts, len(by))
            if found:
                if replace == "all":
                    for name in _names(spark, path):
                        if not parts.endswith(f"/{name}"):
                            remove(spark, f"{path}/{name}")
                schema = frame.drop(*by).schema
                with ThreadPoolExecutor(WRITERS) as pool:
                    writes = [
                        pool.submit(_merge, spark.read.schema(schema).parquet(f"{parts}/{name}"), f"{parts}/{name}", f"{path}/{name}", size, max_records_per_file)
                        for name, size in found.items()
                    ]
                    for write in writes:
                        write.result()
                _file_system(spark, path)[0].create(_path(spark, f"{path}/_SUCCESS"), True).close()
                return
            frame = frame.limit(0)
        finally:
            remove(spark, parts)
    mode = "static" if replace == "all" else "dynamic"
    writer = frame.write.mode("overwrite").options(partitionOverwriteMode=mode, **PARQUET).partitionBy(*by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


#: Bytes of a file of a partitioned dataset, and partitions that are written at a time.
FILE_BYTES = 64 << 20
WRITERS = 8
PARQUET = {"compression": "zstd"}


def _merge(rows: DataFrame, parts: str, path: str, size: int, max_records_per_file: int | None) -> None:
    """One directory's rows in as few files as their stored size asks for, in place of those in ``parts``."""
    writer = rows.coalesce(-(-size // FILE_BYTES)).write.mode("overwrite").options(**PARQUET)
    writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    remove(rows.sparkSession, parts)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    where = _path(spark, path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder."""
    system, where = _file_system(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(where)]


def _directories(spark: SparkSession, path: str, depth: int) -> dict[str, int]:
    """The bytes of each ``by=value`` directory below ``path``, by its name from there."""
    names = [""]
    for _ in range(depth):
        names = [f"{above}/{name}" for above in names for name in _names(spark, f"{path}{above}") if "=" in name]
    sizes = {}
    for name in names:
        system, where = _file_system(spark, f"{path}{name}")
        sizes[name.lstrip("/")] = system.getContentSummary(where).getLength()
    return sizes


def rewrite_partitions(
    frame: DataFrame, path: str, values: Sequence[int | str], folder: str, *, by: str = "Year", **options
) -> None:
    """Replace the partitions ``values`` of a stored dataset by the rows that ``frame`` has for them.

    Other partitions keep their files, whatever ``frame`` holds for them.  A value that ``frame`` has no rows for loses its
    directory.  The rows are stored in ``folder`` first, so ``frame`` may come from the dataset itself.
    """
    spark = frame.sparkSession
    new = staged(frame.where(F.col(by).isin(*values)), f"{folder}/partitions", "zstd", sliced=True)
    write_partitioned(read_slices(spark, f"{folder}/partitions"), path, by=[by], replace="present", **options)
    # At most a row per value.
    held = {row[0] for row in new.select(by).distinct().collect()}
    for value in set(values) - held:
        remove(spark, f"{path}/{by}={value}")


def write_json(frame: DataFrame, path: str) -> None:
    """Write a small metrics table as JSON lines, replacing what is there."""
    frame.repartition(1).write.mode("overwrite").json(path)


def metric_rows(row: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Turn a one-row frame into (metric, value) text rows, in column order.

    Structs, arrays and maps are JSON-encoded; everything else is cast to text
    (booleans read ``true`` / ``false``).
    """
    nested = (T.ArrayType, T.MapType, T.StructType)
    pairs = []
    for field in row.schema.fields:
        cell = F.col(f"`{field.name}`")
        text = F.to_json(cell) if isinstance(field.dataType, nested) else cell.cast("string")
        pairs.append(F.struct(F.lit(field.name).alias(metric), text.alias(value)))
    return row.select(F.inline(F.array(*pairs)))


def _own_folder() -> str:
    """This process's temporary folder, removed when it ends."""
    if "own" not in _folders:
        _folders["own"] = tempfile.mkdtemp(prefix="tallymill-")
        atexit.register(shutil.rmtree, _folders["own"], ignore_errors=True)
    return _folders["own"]


_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    The parent is the session's ``spark.checkpoint.dir``.  Only a local session
    that has none falls back to a temporary folder, and no setting is changed for it.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        parent = _own_folder()
    return f"{parent.rstrip('/')}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is; nothing happens if it is not there."""
    system, where = _file_system(spark, path)
    system.delete(where, True)


def let_go(spark: SparkSession, *folders: str) -> None:
    """Delete staged tables that nothing reads any more, and the shuffle files of finished jobs.

    Spark deletes a shuffle's files once the driver has collected the objects that name it, which
    otherwise may take until the query is over.
    """
    for folder in folders:
        remove(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Stored bytes of wide rows that a task reads, about those of a row group.  Such rows take some 15 times as much in a task's sort.
SLICE_BYTES = 24 << 20


def staged(frame: DataFrame, path: str, compression: str | None = None, *, sliced: bool = False) -> DataFrame:
    """Write ``frame`` as Parquet to shared storage and return the stored copy; ``sliced`` is for ``read_slices``."""
    writer = frame.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if sliced:
        # Before compression.
        writer = writer.option("parquet.block.size", 2 * SLICE_BYTES)
    writer.parquet(path)
    return frame.sparkSession.read.parquet(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """A folder of Parquet files of which a task reads about ``SLICE_BYTES``, row groups permitting.

    That is for wide rows that go to a partitioned write, whose tasks sort what they read.  Spark cuts a scan by its share of the cores up to a limit that is a setting; so the files are
    read by scans that are no larger than that share of all cores, and a small folder by one.
    """
    whole = spark.read.parquet(path)
    system, where = _file_system(spark, path)
    most, scans, held = SLICE_BYTES * spark.sparkContext.defaultParallelism, [[]], 0
    for entry in sorted(system.listStatus(where), key=lambda entry: entry.getPath().getName()):
        name, size = entry.getPath().getName(), entry.getLen()
        if name.startswith(("_", ".")):
            continue
        if scans[-1] and held + size > most:
            scans.append([])
            held = 0
        scans[-1].append(f"{path}/{name}")
        held += size
    if len(scans) == 1:
        return whole
    return reduce(DataFrame.union, [spark.read.schema(whole.schema).parquet(*files) for files in scans])
