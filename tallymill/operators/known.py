"""Dedup of new rows against all that is stored, without shuffling what is stored."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import remove, staged
from .rows import dedup_by_key

#: Bits in a block of the filter (a bitmap of Spark's holds so many) and bits set per key, all in one block.
BLOCK_BITS = 32768
PROBES = 6
#: Bits of the filter per key it is made for: some 1 in 200 unknown keys then pass as known.
BITS_PER_KEY = 12


@dataclass
class KeyStore:
    """Rows kept once per key: a table bucketed by key, and a Bloom filter over its keys bucketed by block.

    ``name`` begins the names of the session's tables, ``root`` is their folder.  ``blocks`` is set when the store is made
    (``blocks_for``); with many more keys than planned the filter passes more keys on and saves less, no more.

    A key's bits all lie in one block, so a probe is one equi-join on the block with the filter, and what may be known
    is one equi-join on the key with the stored table; both stored sides are bucketed and need no
    exchange.  What is certainly new never meets the stored rows.  Rows with a null key part are left out.  The
    filter is written before the rows, so that after a crash it may know too much but never too little.  One writer at a time.
    """

    spark: SparkSession
    name: str
    root: str
    keys: Sequence[str]
    blocks: int
    buckets: int = 64
    version: int = 0

    @staticmethod
    def blocks_for(rows: int) -> int:
        return max(1, -(-rows * BITS_PER_KEY // BLOCK_BITS))

    def _whole(self, frame: DataFrame) -> DataFrame:
        return frame.na.drop("any", subset=list(self.keys))

    def _key(self) -> list[Column]:
        return [F.col(f"`{k}`") for k in self.keys]

    def _probes(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(*self._key(), F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)])

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(*self._key()), F.lit(self.blocks))

    def _save(self, frame: DataFrame, table: str, by: Sequence[str], mode: str) -> None:
        """Rows go to their buckets' tasks first, so that an increment adds one file per bucket."""
        dealt = frame.repartition(self.buckets, *[F.col(f"`{c}`") for c in by])
        writer = dealt.write.mode(mode).bucketBy(self.buckets, *by).sortBy(*by).option("path", f"{self.root}/{table}")
        writer.format("parquet").saveAsTable(f"{self.name}_{table}")

    def stored(self) -> DataFrame:
        return self.spark.table(f"{self.name}_rows")

    def _filter(self) -> DataFrame:
        return self.spark.table(f"{self.name}_filter_{self.version}")

    def _bitmaps(self, frame: DataFrame) -> DataFrame:
        """block, bits of the keys in ``frame``; dealt by block first, so that tasks hold one bitmap per block of theirs."""
        bits = frame.select(self._block().alias("block"), F.explode(self._probes()).alias("bit"))
        return bits.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def create(self, frame: DataFrame) -> None:
        """A new store from the first row of each key."""
        first = staged(dedup_by_key(self._whole(frame), self.keys), f"{self.root}/first")
        self._save(self._bitmaps(first), f"filter_{self.version}", ["block"], "overwrite")
        self._save(first, "rows", list(self.keys), "overwrite")
        remove(self.spark, f"{self.root}/first")

    def perhaps_known(self, frame: DataFrame) -> DataFrame:
        """The rows whose key passes the filter: all known ones, and few others."""
        asked = frame.withColumns({"_block": self._block(), "_probes": self._probes()})
        met = asked.join(self._filter(), F.col("_block") == F.col("block"))
        # Bit i of a bitmap is bit i % 8 of its byte i / 8.
        byte = lambda p: F.conv(F.hex(F.substr("bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        test = F.forall("_probes", lambda p: F.getbit(byte(p), (p % 8).cast("int")) == 1)
        return met.where(test).drop("_block", "_probes", "block", "bits")

    def known(self, frame: DataFrame) -> DataFrame:
        """The keys of ``frame`` that are stored."""
        return self.perhaps_known(frame.select(*self._key())).join(self.stored().select(*self._key()), list(self.keys), "left_semi")

    def new_rows(self, frame: DataFrame) -> DataFrame:
        """The first row of each key that is not stored yet; what is stored stays as it is.

        The first rows are put in ``root/asked`` until the next call, since they are read twice.
        """
        first = staged(dedup_by_key(self._whole(frame), self.keys), f"{self.root}/asked")
        return first.join(self.known(first), list(self.keys), "left_anti").select(*[F.col(f"`{c}`") for c in frame.columns])

    def add(self, frame: DataFrame) -> DataFrame:
        """Store ``new_rows``; the rows that were added."""
        number = self.version + 1
        fresh = staged(self.new_rows(frame), f"{self.root}/increment_{number}")
        both = self._filter().unionByName(self._bitmaps(fresh))
        merged = both.repartition(self.buckets, "block").groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        self._save(merged, f"filter_{number}", ["block"], "overwrite")
        old, self.version = self.version, number
        self._save(fresh, "rows", list(self.keys), "append")
        self.spark.sql(f"DROP TABLE {self.name}_filter_{old}")
        remove(self.spark, f"{self.root}/filter_{old}")
        remove(self.spark, f"{self.root}/asked")
        return fresh
