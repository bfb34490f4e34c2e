"""Substring dedup by content-defined chunking.

A gear rolling hash over the last WINDOW bytes ranks every place of a text, and of every REACH neighbouring places the
one of least rank is a cut, the last of equals.  So chunks lie between cuts that hang on nearby bytes alone, vary in
length up to REACH, and an insertion moves only the cuts beside it.  A chunk is deduplicated by the digest of its bytes
and of the LEAD bytes before it, which keep short chunks from meeting by chance.  Two equal stretches of STRETCH bytes
have a chunk in common, whatever they hold.  Chunks that also stand in
another document join to runs, a run's two ends are carried on byte by byte as long as some other
document goes on alike, and only then its length is tested.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .spread import Batches, gathered, shared, stage
from .text import Texts, chunks, mix, span_hashes

#: Bytes that the gear hash of a place has seen.
WINDOW = 16
#: Neighbouring places of which one is a cut; no chunk is longer.
REACH = 32
#: Bytes before a chunk that its digest takes in, WINDOW at least.
LEAD = 32
STRETCH = LEAD + 2 * REACH - 1
#: Bytes beside a chunk by which its places are dealt out.
NEAR = 3
#: A span counts from this many bytes, from end to end; 51 words have 101 at least.
LEAST_BYTES = 96

GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cut_places(texts: Texts) -> np.ndarray:
    """Sorted places in the texts' bytes before which a chunk ends; a text has none in its first LEAD bytes."""
    rank = GEAR[texts.data]
    width = 1
    while width < WINDOW:
        rank[width:] += rank[:-width] << np.uint32(width)
        width *= 2
    size = len(rank)
    if size < REACH:
        return np.zeros(0, np.int64)
    # the place counts from the end and stands below the rank, so that of equals the last is least
    least = rank.astype(np.uint64)
    least <<= np.uint64(32)
    least |= np.arange(size - 1, -1, -1, dtype=np.uint64)
    width = 1
    while width < REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    # of each text: places whose windows reach before it or into its first bytes, whole ones, those that reach beyond it
    long = np.diff(texts.offsets)
    some = np.maximum(long - (LEAD - 1) - (REACH - 1), 0)
    before = np.where(some > 0, LEAD - 1, long)
    whole = np.repeat(np.tile([False, True, False], len(long)), np.stack([before, some, long - before - some], axis=1).ravel())
    least = least[whole[: len(least)]]  # places rise
    if not len(least):
        return np.zeros(0, np.int64)
    least = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return size - (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def digested(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start (with the bytes before it), end and digest of each chunk between two cuts of a text."""
    cuts = cut_places(texts)
    row = np.searchsorted(texts.offsets, cuts - 1, "right") - 1
    beside = np.flatnonzero(row[1:] == row[:-1])
    starts, ends = cuts[beside] - LEAD, cuts[beside + 1]
    return row[beside], starts, ends, span_hashes(texts, starts, ends)


def _chunk(batches: Batches, places: bool) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 40
    for batch in batches:
        for texts in chunks(batch.column("text")):
            row, starts, ends, digest = digested(texts)
            of = lambda name: batch.column(name).slice(texts.first, len(texts)).take(pa.array(row))
            columns, names = [pa.array(digest.view(np.int64)), of("doc_id")], ["digest", "doc_id"]
            if places:
                within = pa.array((starts - texts.offsets[row]).astype(np.int32))
                columns += [of("key"), pa.array(number + row), within, pa.array((ends - starts).astype(np.int32))]
                names += ["key", "row", "start", "long"]
            number += len(texts)
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _whole_rows(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The same rows in order, no document's chunks in two batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        row = batch.column("row").to_numpy()
        if held and row[0] != held[-1].column("row")[0].as_py():
            yield pa.concat_batches(held)
            held = []
        cut = int(np.searchsorted(row, row[-1]))
        if cut:
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _sided(batches: Batches) -> Iterator[pa.RecordBatch]:
    """begins, ends: whether a chunk begins or ends less than REACH bytes from that side of its run.

    Another document may have only the next chunk in common, less than REACH bytes on.
    """
    for batch in _whole_rows(batches):
        row, start, long = (batch.column(n).to_numpy() for n in ("row", "start", "long"))
        end = start + long
        apart = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
        first = np.flatnonzero(np.concatenate([[True], apart]))
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(row))))
        last = np.append(first[1:], len(row)) - 1
        begins, ends = start - start[first][run] < REACH, end[last][run] - end < REACH
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(begins), pa.array(ends)], names=[*batch.schema.names, "begins", "ends"])


def _stretches(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Adjoining chunks inside a run as one row, where all are held first or all are copies.

    Nothing is carried on from chunks that neither begin nor end their run, and what is carried on from the others
    starts before or behind them all.  A stretch that lies in two batches makes two rows.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        row, doc_id, start, long, first_doc_id = (batch.column(n).to_numpy() for n in ("row", "doc_id", "start", "long", "first_doc_id"))
        inner = ~pc.or_(batch.column("begins"), batch.column("ends")).to_numpy(zero_copy_only=False)
        low, high, kept = start.astype(np.int64), start.astype(np.int64) + long, doc_id == first_doc_id
        on = inner[1:] & inner[:-1] & (row[1:] == row[:-1]) & (kept[1:] == kept[:-1]) & (low[1:] + LEAD == high[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~on]))
        upto = np.append(first[1:], len(row))
        columns = [row[first], doc_id[first], low[first], high[upto - 1], np.minimum.reduceat(first_doc_id, first), upto - first]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "doc_id", "low", "high", "first_doc_id", "chunks"])


def _beside(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The up to REACH - 1 bytes before or behind each edge's chunk, the nearest first."""
    for batch in batches:
        for texts in chunks(batch.column("text")):
            edges = batch.column("edges").slice(texts.first, len(texts))
            row = np.repeat(np.arange(len(texts)), edges.value_lengths().to_numpy())
            flat = edges.flatten()
            start, long, before = (flat.field(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            low, high = texts.offsets[row], texts.offsets[row + 1]
            at = low + start
            size = np.minimum(np.where(before, start, high - at - long), REACH - 1)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            nth = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
            first, step = np.where(before, at - 1, at + long), np.where(before, -1, 1)
            data = texts.data[np.repeat(first, size) + nth * np.repeat(step, size)].tobytes()
            beside = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            of = lambda name: batch.column(name).slice(texts.first, len(texts)).take(pa.array(row))
            columns = [flat.field(0), of("doc_id"), of("key"), *(flat.field(k) for k in (1, 2, 3, 4)), beside]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "doc_id", "key", "start", "long", "before", "own", "beside"])


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    size = pc.binary_length(column).fill_null(0).to_numpy()
    data = np.frombuffer(b"".join(x for x in column.to_pylist() if x), np.uint8)
    out = np.zeros((len(size), REACH - 1), np.uint8)
    out[np.arange(REACH - 1) < size[:, None]] = data
    return out, size


def _alike(batches: Batches) -> Iterator[pa.RecordBatch]:
    """size: with how many of its first bytes ``beside`` begins as ``up`` or ``down`` does."""
    for batch in batches:
        own, long = _padded(batch.column("beside"))
        size = np.zeros(len(own), np.int64)
        for name in ("up", "down"):
            other, most = _padded(batch.column(name))
            differs = np.concatenate([own != other, np.ones((len(own), 1), bool)], axis=1)
            size = np.maximum(size, np.minimum(differs.argmax(axis=1), np.minimum(long, most)))
        names = ["digest", "before", "beside", "first", "last"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(size)], names=[*names, "size"])


def _carried(places: DataFrame, folder: str) -> DataFrame:
    """doc_id, key, start, long, before, size and first_doc_id for edges of which another document goes on alike for size bytes.

    Of sorted neighbours one goes on alike longest, but for those of the same document, which are passed over.  Neighbours are
    sought among those alike in NEAR bytes; shorter beginnings are counted.
    """
    places = places.where("beside <> X''")
    by = ["digest", "before"]
    kinds = places.groupBy(*by, "beside").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    kinds = stage(kinds, folder, "beside")
    line = W.partitionBy(*by, F.substring("beside", 1, NEAR)).orderBy("beside")
    alone = F.col("first") == F.col("last")
    as_other = lambda f: F.coalesce(alone & (f("first").over(line) == F.col("first")) & (f("last").over(line) == F.col("last")), F.lit(False))
    sorted_ = kinds.withColumns(
        {"up": F.when(~as_other(F.lag), F.lag("beside").over(line)), "down": F.when(~as_other(F.lead), F.lead("beside").over(line))}
    )
    up = F.last("up", True).over(line.rowsBetween(W.unboundedPreceding, 0))
    # the next below, by rows that fall: a frame to the last row is read anew for every row of a group
    falling = W.partitionBy(*by, F.substring("beside", 1, NEAR)).orderBy(F.desc("beside"))
    down = F.last("down", True).over(falling.rowsBetween(W.unboundedPreceding, 0))
    near = sorted_.withColumns({"up": up, "down": down}).mapInArrow(
        _alike, "digest long, before boolean, beside binary, first long, last long, size long"
    )
    size = F.when(alone, F.col("size")).otherwise(F.length("beside"))
    for n in range(1, NEAR):
        head = F.substring("beside", 1, n)
        short = kinds.where(F.length("beside") >= n).groupBy(*by, head.alias("head")).agg(F.min("first").alias("f"), F.max("last").alias("l"))
        short = short.where("f < l").select(*by, "head", F.lit(n).alias(f"short_{n}"))
        near = near.withColumn("head", head).join(short, [*by, "head"], "left").drop("head")
        size = F.greatest(size, F.coalesce(F.least(f"short_{n}", F.length("beside")), F.lit(0)))
    sizes = stage(near.select(*by, "beside", size.cast("int").alias("size")).where("size > 0"), folder, "sizes")
    edges = stage(places.where("own").join(sizes, [*by, "beside"]), folder, "carried")
    head = F.expr("substring(beside, 1, size)").alias("head")
    asked = edges.select(*by, "size").distinct()
    heads = kinds.join(asked, by).where(F.length("beside") >= F.col("size")).groupBy(*by, "size", head).agg(F.min("first").alias("first_doc_id"))
    found = edges.withColumn("head", head).join(stage(heads, folder, "heads"), [*by, "size", "head"])
    return found.select("doc_id", "key", "start", "long", "before", "size", "first_doc_id")


def _in_several(digests: DataFrame) -> DataFrame:
    by = digests.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
    return by.where("first_doc_id < last").select("digest", "first_doc_id")


def repeated_spans(documents: DataFrame, *, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """One row per span that stands in several documents; a document without one has no row.

    doc_id, start and length in bytes of the UTF-8 text, chunks (those and the carried ends it is made of), first_doc_id
    (the smallest doc_id that has any of them) and kept (true in the document that holds them first, false where they are copies).
    Every byte of a copy stands in a document of a smaller doc_id.  A passage of ``least_bytes``, at least STRETCH,
    is found in all documents that hold it, whatever it holds.  A part held first that is shorter
    is given with bytes beside it, a copy that is shorter counts with what is held first.
    Only doc_id and text are read.  Null, empty and short texts have no spans.  Rows that share a
    doc_id are one document, so what only they repeat is not reported; rows without doc_id are left out.
    """
    if least_bytes < STRETCH:
        raise ValueError(f"a span has at least {STRETCH} bytes")
    frame = documents.where("doc_id IS NOT NULL AND text <> ''").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    folder = shared(documents)
    keyed = frame.withColumn("key", F.xxhash64("text"))
    digests = frame.mapInArrow(partial(_chunk, places=False), "digest long, doc_id long")
    common = stage(_in_several(digests), folder, "common")
    columns = "digest long, doc_id long, key long, row long, start int, long int"
    places = keyed.mapInArrow(partial(_chunk, places=True), columns).join(common.hint("shuffle_hash"), "digest")
    sided = gathered(places, ["row"], ["start"]).mapInArrow(_sided, f"{columns}, first_doc_id long, begins boolean, ends boolean")
    found = stage(sided, folder, "found")
    # all places of the chunks that stand where some run begins or ends
    edges = stage(
        found.where("begins OR ends").groupBy("digest").agg(F.max("begins").alias("any_begins"), F.max("ends").alias("any_ends")),
        folder,
        "edges",
    )
    side = lambda before, own: F.struct("digest", "start", "long", F.lit(before).alias("before"), F.col(own).alias("own"))
    sides = F.array_compact(F.array(F.when(F.col("any_begins"), side(True, "begins")), F.when(F.col("any_ends"), side(False, "ends"))))
    lists = found.join(edges, "digest").groupBy("doc_id", "key").agg(F.flatten(F.collect_set(sides)).alias("edges"))
    beside = keyed.dropDuplicates(["doc_id", "key"]).join(lists, ["doc_id", "key"]).mapInArrow(
        _beside, "digest long, doc_id long, key long, start int, long int, before boolean, own boolean, beside binary"
    )
    most = _carried(stage(beside, folder, "places_beside"), folder)
    low = F.col("start") - F.when(F.col("before"), F.col("size")).otherwise(0)
    high = F.col("start") + F.col("long") + F.when(F.col("before"), 0).otherwise(F.col("size"))
    rows = found.select("row", "doc_id", "key").distinct()
    longer = rows.join(most, ["doc_id", "key"]).select(
        "row", "doc_id", low.cast("long").alias("low"), high.cast("long").alias("high"), "first_doc_id", F.lit(1).cast("long").alias("chunks")
    )
    whole = found.drop("digest", "key").mapInArrow(
        _stretches, "row long, doc_id long, low long, high long, first_doc_id long, chunks long"
    )
    # runs of chunks that touch, and in them parts that are held first or copies
    parts = whole.unionByName(longer).withColumn("kept", F.col("doc_id") == F.col("first_doc_id"))
    line = W.partitionBy("row").orderBy("low", "high")
    so_far = line.rowsBetween(W.unboundedPreceding, 0)
    apart = F.coalesce(F.col("low") > F.max("high").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    turns = lambda new, kept: F.coalesce(new | (F.lag(kept).over(line) != F.col(kept)), F.lit(True)).cast("int")
    runs = parts.withColumn("apart", apart).withColumn("turns", turns(F.col("apart"), "kept"))
    runs = runs.withColumns({"run": F.sum(F.col("apart").cast("int")).over(so_far), "part": F.sum("turns").over(so_far)})
    run, part = W.partitionBy("row", "run"), W.partitionBy("row", "part")
    runs = runs.withColumns({"from": F.min("low").over(run), "to": F.max("high").over(run)})
    runs = runs.where(F.col("to") - F.col("from") >= least_bytes)
    held = F.col("kept") | (F.max("high").over(part) - F.min("low").over(part) < least_bytes)
    runs = runs.withColumn("kept", held)
    runs = runs.withColumn("turns", turns(F.col("apart"), "kept")).withColumn("part", F.sum("turns").over(so_far))
    spans = runs.groupBy("row", "part", "doc_id", "kept", "from", "to").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("chunks").alias("chunks"),
        F.min("first_doc_id").alias("first_doc_id"),
    )
    start = F.least("low", F.greatest("from", F.col("high") - least_bytes))
    return spans.select(
        "doc_id",
        start.alias("start"),
        (F.greatest("high", F.least("to", start + least_bytes)) - start).alias("length"),
        "chunks",
        F.when(F.col("kept"), F.col("doc_id")).otherwise(F.col("first_doc_id")).alias("first_doc_id"),
        "kept",
    )
