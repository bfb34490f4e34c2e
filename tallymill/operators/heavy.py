"""The largest groups of a key with very many values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import staged

#: Buckets that keys are hashed to for the proof, and candidates at most.
BUCKETS = 1 << 16
CANDIDATES = 4096


def largest_groups(
    frame: DataFrame,
    key: str | Column,
    k: int,
    folder: str,
    *,
    name: str = "key",
    count: str = "row_count",
    buckets: int = BUCKETS,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """The ``k`` values of a key with most rows, by count and then value; exact, null included as a value.

    Grouping a key that has nearly as many values as rows shuffles nearly all rows for a handful of groups.  Here

    1. a mergeable heavy-hitter sketch, made in the map tasks, names candidates;
    2. a pass counts them exactly, and in the same pass all other rows by bucket of their hash.  No other value has
       more rows than its bucket, so buckets below the k-th candidate's count are proven to hold none of the result;
    3. the rows of the other buckets, if any, are counted value by value.

    So the result never rests on the sketch: a bad one leaves more buckets to step 3, at worst all.  Steps 1 and 2 ship
    a sketch and at most ``candidates`` + ``buckets`` counts per task.  ``frame`` is read up to three times and
    should be stored.  Values are compared as text.
    """
    value = (F.col(key) if isinstance(key, str) else key).cast("string")
    # A mark before the value parts null from the empty text and from any other.
    rows = frame.select(F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias("_v"))
    tracked = max(8, min(candidates, 1 << 14))
    sketch = rows.agg(F.expr(f"approx_top_k(_v, {min(tracked, max(k, tracked // 4))}, {tracked})").alias("top"))
    named = staged(sketch.select(F.explode("top.item").alias("_v")).distinct(), f"{folder}/candidates")
    marked = rows.join(named.withColumn("_named", F.lit(True)), "_v", "left")
    bucket = F.pmod(F.xxhash64("_v"), F.lit(buckets))
    other = F.col("_named").isNull()
    parts = marked.groupBy(F.when(~other, F.col("_v")).alias("_v"), F.when(other, bucket).alias("_bucket"))
    counted = staged(parts.agg(F.count("*").alias(count)), f"{folder}/counted")
    known = counted.where("_bucket IS NULL").select("_v", count)
    order = [F.desc(count), F.asc("_v")]
    # One row with the k-th count; without k candidates nothing is proven.
    least = known.orderBy(*order).limit(k).agg(F.count("*").alias("n"), F.min(count).alias("least"))
    bound = least.select(F.when(F.col("n") >= k, F.col("least")).otherwise(0)).scalar()
    unproven = staged(counted.where("_bucket IS NOT NULL").where(F.col(count) >= bound).select("_bucket"), f"{folder}/unproven")
    rest = rows.withColumn("_bucket", bucket).join(unproven, "_bucket", "left_semi").join(named, "_v", "left_anti")
    every = known.unionByName(rest.groupBy("_v").agg(F.count("*").alias(count)))
    top = every.orderBy(*order).limit(k)
    return top.select(F.when(F.col("_v") != "", F.substr("_v", F.lit(2))).alias(name), count)

