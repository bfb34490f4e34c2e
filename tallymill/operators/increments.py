"""Counts kept per input file, and brought up to date from new files alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import exists, input_files

FILE = "file"
LEDGER = "file STRING, size BIGINT, modified TIMESTAMP, increment INT"


@dataclass(frozen=True)
class PartialCounts:
    """Stored partial aggregates below ``root``: a row per input file and key combination.

    ``count`` turns a list of files into such rows: ``file``, the keys, and ``measures``, which add up.  Each increment is
    written to a folder of its own, and entered in the ledger last; an increment that dies before that counts for
    nothing and is written anew.  A file that has changed (size or time) is counted again, and its earlier rows no
    longer count; one that is gone keeps its counts.  One increment runs at a time.  The names of new files pass
    through the driver, which lists all files in any case.
    """

    spark: SparkSession
    root: str
    keys: Sequence[str]
    measures: Sequence[str]
    count: Callable[[list[str]], DataFrame]

    def ledger(self) -> DataFrame:
        """The files counted so far, each with the increment that counts."""
        if not exists(self.spark, f"{self.root}/ledger"):
            return self.spark.createDataFrame([], LEDGER)
        every = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger")
        return every.groupBy(FILE).agg(F.max_by(F.struct("size", "modified", "increment"), "increment").alias("last")).select(FILE, "last.*")

    def pending(self, path: str | list[str]) -> DataFrame:
        """The files below ``path`` that are new or have changed."""
        return input_files(self.spark, path).join(self.ledger(), [FILE, "size", "modified"], "left_anti")

    def add(self, path: str | list[str]) -> list[str]:
        """Count what is pending; the files that were read."""
        fresh = self.pending(path).collect()
        if not fresh:
            return []
        number = (self.ledger().agg(F.max("increment")).first()[0] or 0) + 1
        files = sorted(r[FILE] for r in fresh)
        self.count(files).write.mode("overwrite").parquet(f"{self.root}/partials/increment={number}")
        entered = self.spark.createDataFrame(fresh, LEDGER.rsplit(",", 1)[0]).repartition(1)
        entered.write.mode("overwrite").parquet(f"{self.root}/ledger/increment={number}")
        return files

    def merged(self) -> DataFrame:
        """The sums over all files per key combination."""
        current = self.ledger().select(FILE, "increment")
        rows = self.spark.read.option("mergeSchema", False).parquet(f"{self.root}/partials")
        sums = [F.sum(m).alias(m) for m in self.measures]
        return rows.join(current, [FILE, "increment"], "left_semi").groupBy(*self.keys).agg(*sums)
