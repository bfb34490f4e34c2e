"""Spark helpers the operators share: groups in blocks, connected components, staging."""

from __future__ import annotations

import gc
import pathlib
import tempfile
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import remove, shared_folder, staged

Batches = Iterable[pa.RecordBatch]


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed; once per context."""
    context = spark.sparkContext
    if getattr(context, "_tallymill_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parents[1]
    made = pathlib.Path(tempfile.mkdtemp(prefix="tallymill-")) / "tallymill.zip"
    with zipfile.ZipFile(made, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(made))
    context._tallymill_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(frame: DataFrame, folder: str, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: a written table survives the loss of any executor."""
    return staged(frame, f"{folder}/{name}", compression)


def let_go(spark: SparkSession, *folders: str) -> None:
    """Delete staged tables that nothing reads any more, and the shuffle files of finished jobs.

    Spark deletes a shuffle's files once the driver has collected the objects that name it, which
    otherwise may take until the query is over.
    """
    for folder in folders:
        remove(spark, folder)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared(frame: DataFrame) -> str:
    return shared_folder(frame.sparkSession)


def in_blocks(rows: DataFrame, salt: str, block: int) -> DataFrame:
    """Deal the rows of each key into blocks and pair the blocks.

    Each row has n, the rows of its key; it is joined while rows are narrow.  A key of n rows
    gets ceil(n / block) blocks, and each row goes to every pair of blocks that its own is
    in, with ``left`` and ``right`` naming the pair.  So a task meets about two blocks at
    most, and every two rows of a key meet in exactly one pair of blocks, or, from one block, in that
    block's pair with itself.  ``salt`` is the column that spreads rows over blocks.
    """
    many = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(salt), many).cast("int")
    dealt = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), many - 1)))
    return (
        dealt.withColumn("left", F.least("_own", "_other"))
        .withColumn("right", F.greatest("_own", "_other"))
        .withColumn("own", F.col("_own"))
        .drop("_own", "_other", "n")
    )


def gathered(frame: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of a key together in one task, one key after the other."""
    return frame.repartition(*key).sortWithinPartitions(*key, *order)


def groups(batches: Batches, key: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each key of a ``gathered`` frame, whatever batches they arrive in."""
    kept: list[pa.RecordBatch] = []
    last = None

    def flush() -> Iterator[pa.Table]:
        if kept:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for name in key:
            column = batch.column(name)
            differs = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
            change[1:] |= differs.fill_null(True).to_numpy(zero_copy_only=False)
        first = tuple(batch.column(name)[0].as_py() for name in key)
        if first != last:
            yield from flush()
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for i, (at, to) in enumerate(zip(cuts[:-1], cuts[1:])):
            if i:
                yield from flush()
            kept.append(batch.slice(at, to - at))
        last = tuple(batch.column(name)[batch.num_rows - 1].as_py() for name in key)
    yield from flush()


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index of each of n local nodes' components over edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is one of its nodes.

    Each round every node moves to the least of itself and its neighbours, and to where that one
    moves, and the edges are rewritten and made distinct.  A star is done in two rounds; nodes
    named by digests stand in a chain in random order, of which a round leaves a fraction, so
    the rounds grow with the logarithm of the longest chain.  Every round is staged; joins are plain equi-joins of staged tables, which
    adaptive execution can split where one node has many edges.
    """
    left = stage(edges.where("a <> b").select("a", "b").distinct(), folder, "edges_0")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        k = len(moves)
        both = left.union(left.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        step = stage(least, folder, f"steps_{k}")
        jump = step.select(F.col("a").alias("to"), F.col("to").alias("then"))
        move = stage(step.join(jump, "to").select("a", F.col("then").alias("to")), folder, f"moves_{k}")
        first = left.join(move.withColumnRenamed("to", "x"), "a")
        second = first.join(move.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        nxt = second.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        moves.append(move)
        left = stage(nxt.distinct(), folder, f"edges_{k + 1}")
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = moves[-1].select(F.col("a").alias("node"), F.col("to").alias("component"))
    for move in reversed(moves[:-1]):
        later = found.select(F.col("node").alias("to"), "component")
        found = move.join(later, "to", "left").select(
            F.col("a").alias("node"), F.coalesce("component", "to").alias("component")
        )
    return found if len(moves) == 1 else stage(found, folder, "components")
