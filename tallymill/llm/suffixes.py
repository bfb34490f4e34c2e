"""Substring dedup by suffix arrays of the difference-cover kind.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else.  Equal strings are neighbours
among the sorted suffixes, so sorted suffixes and a comparison of neighbours find them all:

* dealing: of each window of LENGTH bytes the gram of GRAM bytes with the least hash (the first of equals) names
  the window's bucket.  Equal windows hold equal grams, so they meet in one bucket.  Consecutive windows with
  one gram in common form a stretch, which travels as one row;
* names: stretches get digests.  A stretch met twice repeats as a whole and needs no sorting; a bucket of one
  stretch repeats nowhere.  What is left is buckets that hold different stretches, the edges of repeats;
* sorting: the suffixes of such buckets are sorted in tasks by the difference cover modulo three: triples at
  positions 1 and 2 modulo 3 are sorted and named, the names' string is sorted by recursion, the
  remaining suffixes are sorted by their first symbol and the next one's rank, both are merged, and
  neighbours are compared over LENGTH bytes.  The recursion ends when names cover LENGTH bytes;
* hot buckets, with more than BUCKET different stretches, are halved first: each half of a stretch's windows is a
  shorter stretch, dealt anew by the bytes that all its windows hold, named and counted again.  Halves of one window need no sorting.

Nothing is dropped on the way: two windows are compared by all their bytes or by 96-bit digests of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import Batches, gathered, groups, let_go, shared, stage
from .text import chunks, mix

LENGTH = 200
GRAM = 32
#: Different stretches that one bucket may bring to a task.
BUCKET = 4096
#: Windows of a text handled at a time; longer texts go piece by piece.
PIECE = 1 << 20
#: Bytes whose suffixes are sorted at a time, whole buckets.
BATCH = 1 << 18
_LOW = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each position; ``gram`` is a power of two from 8 on."""
    out = data.astype(np.uint64)
    width = 1
    while width < 8:
        out = out[: len(out) - width] | (out[width:] << np.uint64(8 * width))
        width *= 2
    out = mix(out)
    while width < gram:
        out = mix(out[: len(out) - width] * np.uint64(0x9E3779B97F4A7C15) + out[width:])
        width *= 2
    return out


def stretches(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, place of the gram from there, and bucket, of each stretch.

    ``data`` is at least ``length`` long.
    """
    hashes = gram_hashes(data, gram)
    keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    span = length - gram + 1
    padded = np.full(-(-len(keys) // span) * span, np.iinfo(np.uint64).max)
    padded[: len(keys)] = keys
    block = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - span + 1
    least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & _LOW
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    where = least[starts].astype(np.int64)
    return starts, np.diff(np.append(starts, n)), where - starts, hashes[where]


def _batch(columns: dict[str, tuple], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (name, kind) columns as one batch."""
    cells = list(zip(*rows)) or [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, columns.values())], names=list(columns))


LONG, INT, BYTES = pa.int64(), pa.int32(), pa.binary()
#: ``place`` holds start, windows and at in one number, and whether the stretch came up twice in one piece of text.
DEALT = {"row": LONG, "place": LONG, "bucket": LONG, "name": LONG, "tail": INT}
PLACED = {"row": LONG, "place": LONG, "bucket": LONG, "n": LONG, "k": LONG, "bytes": BYTES}
HALVED = DEALT | {"n": LONG, "low": LONG, "high": LONG, "bytes": BYTES}
SPANS = {"row": LONG, "start": LONG, "windows": LONG}


def _place(start: int, windows: int, at: int, twice: bool = False) -> int:
    return start << 32 | windows << 16 | at << 1 | twice


def _unplace(place: int) -> tuple[int, int, int]:
    return place >> 32, place >> 16 & 0xFFFF, place >> 1 & 0x7FFF


def _windows() -> list:
    """start and windows of a place, as columns."""
    place = F.col("place")
    return [F.shiftright(place, 32).alias("start"), F.shiftright(place, 16).bitwiseAND(0xFFFF).alias("windows")]


def _name(data: memoryview | bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(data, digest_size=12).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _ddl(columns: dict[str, pa.DataType]) -> str:
    names = {LONG: "long", INT: "int", BYTES: "binary"}
    return ", ".join(f"`{name}` {names[kind]}" for name, kind in columns.items())


def _dealt(batches: Batches, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(row, text) to stretches; of one that comes up several times here the first says so, the others have no bucket."""
    for batch in batches:
        ids = batch.column("row").to_pylist()
        for texts in chunks(batch.column("text")):
            found: list[tuple] = []
            for i in range(len(texts)):
                data = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
                row = ids[texts.first + i]
                for shift in range(0, len(data) - length + 1, PIECE):
                    part = np.ascontiguousarray(data[shift : shift + PIECE + length - 1])
                    first, many, at, bucket = stretches(part, length, gram)
                    view = memoryview(part)
                    ends = (first + many + (length - 1)).tolist()
                    names = [_name(view[s:e]) for s, e in zip(first.tolist(), ends)]
                    places = ((first + shift) << 32 | many << 16 | at << 1).tolist()
                    found += zip([row] * len(names), places, bucket.view(np.int64).tolist(), names)
                    if len(found) > 1 << 16:
                        yield _batch(DEALT, _counted(found))
                        found = []
            if found:
                yield _batch(DEALT, _counted(found))


def _counted(found: list[tuple]) -> list[tuple]:
    times: dict[tuple[int, int], int] = {}
    for *_, name in found:
        times[name] = times.get(name, 0) + 1
    out, seen = [], set()
    for row, place, bucket, name in found:
        out.append((row, place | (times[name] > 1), None if name in seen else bucket, *name))
        seen.add(name)
    return out


def suffix_order(t: np.ndarray, need: int) -> np.ndarray:
    """Positions of ``t`` (symbols from 1 on) so that suffixes stand in the order of their first ``need`` symbols.

    Suffixes alike in those symbols stand together, in some order.
    """
    n = len(t)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    s = np.zeros(n + 3, np.int64)
    s[:n] = t
    # Sampled positions; the one past the end keeps the two halves of the names' string apart.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    top = int(t.max()) + 1
    if top < 1 << 21:
        triple = (s[sample] * top + s[sample + 1]) * top + s[sample + 2]
        order = np.argsort(triple)
        new = np.diff(triple[order]) != 0
    else:
        order = np.lexsort((s[sample + 2], s[sample + 1], s[sample]))
        ahead, behind = sample[order[1:]], sample[order[:-1]]
        new = (s[ahead] != s[behind]) | (s[ahead + 1] != s[behind + 1]) | (s[ahead + 2] != s[behind + 2])
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(new)])
    if need > 3 and len(order) and names[order[-1]] < len(order):
        order = suffix_order(names, -(-need // 3))
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sorted12 = sample[order]
    sorted12 = sorted12[sorted12 < n]
    # The remaining suffixes by their first symbol and the rank of what follows; then merged with those at 1 by
    # the same key, and with those at 2 by a symbol and the place of what follows among the suffixes at 0 and 1.
    ones, twos = sorted12[sorted12 % 3 == 1], sorted12[sorted12 % 3 == 2]
    zero = np.arange(0, n, 3)
    key = s[:n] * (n + 3) + rank[1 : n + 1]
    zero = zero[np.argsort(key[zero])]
    before1 = np.arange(len(zero)) + np.searchsorted(key[ones], key[zero])
    place = np.zeros(n + 3, np.int64)
    place[zero] = before1 + 1
    place[ones] = np.arange(len(ones)) + np.searchsorted(key[zero], key[ones], "right") + 1
    key = s[:n] * (n + 3) + place[1 : n + 1]
    where = np.empty(n, np.int64)
    where[sorted12] = np.arange(len(sorted12))
    final = np.empty(n, np.int64)
    final[zero] = before1 + np.searchsorted(key[twos], key[zero])
    final[ones] = where[ones] + place[ones] - 1 - np.arange(len(ones))
    final[twos] = where[twos] + np.searchsorted(key[zero], key[twos], "right")
    return np.argsort(final)


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Per text, for each of its windows, whether the window starts more than once in ``texts``."""
    sizes = np.array([len(x) for x in texts])
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.frombuffer(b"\x00".join(texts) + bytes(length + 8), np.uint8)
    symbols = data[: offsets[-1]].astype(np.int64) + 1
    symbols[offsets[1:] - 1] = 257
    starts = np.zeros(offsets[-1], bool)
    for at, size in zip(offsets[:-1], sizes):
        starts[at : at + max(0, size - length + 1)] = True
    order = suffix_order(symbols, length)
    order = order[starts[order]]
    a, b = order[:-1], order[1:]
    live = np.arange(len(a))
    eight = data.astype(np.uint64)
    for width in (1, 2, 4):
        eight = eight[: len(eight) - width] | (eight[width:] << np.uint64(8 * width))
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        live = live[eight[a[live] + at] == eight[b[live] + at]]
    found = np.zeros(len(symbols), bool)
    found[a[live]] = found[b[live]] = True
    return [found[at : at + max(0, size - length + 1)] for at, size in zip(offsets[:-1], sizes)]


def _sorted(batches: Batches, length: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets of different stretches to the places of their repeated windows."""

    def spans(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        out: list[tuple] = []
        for (row, place, n, _), found in zip(held, repeated_windows([h[3] for h in held], length)):
            if n > 1:  # repeats as a whole, known already
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], found.view(np.int8), [0]])))
            start = _unplace(place)[0]
            out += [(row, start + a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
        return _batch(SPANS, out)

    held: list[tuple[int, int, int, bytes]] = []
    size = 0
    for group in groups(batches, ["bucket"]):
        got = list(zip(*(group.column(c).to_pylist() for c in ("row", "place", "n", "bytes"))))
        held += got
        size += sum(len(x[3]) for x in got)
        if size >= BATCH:
            yield spans(held)
            held, size = [], 0
    if held:
        yield spans(held)


def _cut(batches: Batches, length: int) -> Iterator[pa.RecordBatch]:
    """(row, text, places) to a row per place, with its bytes."""
    for batch in batches:
        places = batch.column("places").to_pylist()
        for row, text, several in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), places):
            data = text.encode()
            out = []
            for p in several:
                start, windows, _ = _unplace(p["place"])
                out.append((row, p["place"], p["bucket"], p["n"], p["k"], data[start : start + windows + length - 1]))
            yield _batch(PLACED, out)


def _halved(batches: Batches, length: int) -> Iterator[pa.RecordBatch]:
    """Stretches of hot buckets as two each, dealt by the bytes that all windows of a half share.

    A window's place is told from the bucket's gram: it starts ``low`` to ``high`` - 1 bytes before it.  So equal windows
    come to the same half, and the bytes that every window of the half holds are equal too.
    """
    for batch in batches:
        out: list[tuple] = []
        cells = (batch.column(c).to_pylist() for c in ("row", "place", "bucket", "n", "low", "high", "bytes"))
        for row, place, bucket, n, low, high, data in zip(*cells):
            start, _, at = _unplace(place)
            middle = (low + high) // 2
            for lo, hi in ((low, middle), (middle, high)):
                first, last = max(0, at - hi + 1), min(len(data) - length, at - lo)
                if first > last:
                    continue
                core = data[at - lo : at - hi + 1 + length]
                text = data[first : last + length]
                dealt = hashlib.blake2b(core, digest_size=8, key=b"%d %d %d" % (bucket, lo, hi)).digest()
                place = _place(start + first, last - first + 1, at - first, n > 1)
                out.append((row, place, int.from_bytes(dealt, "big", signed=True), *_name(text), n, lo, hi, text))
        yield _batch(HALVED, out)


def _without(batches: Batches, length: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, found) to what is kept of the text and the spans that go."""
    for batch in batches:
        kept, spans = [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            data = (text or "").encode()
            runs: list[list[int]] = []
            for start, stop in sorted((f["start"], f["start"] + f["windows"] + length - 1) for f in found or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(stop, runs[-1][1])
                else:
                    runs.append([start, stop])
            ends = [0, *(x for run in runs for x in run), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2])))
            spans.append([{"start": a, "stop": b} for a, b in runs])
        kind = pa.list_(pa.struct([("start", LONG), ("stop", LONG)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(spans, kind), pa.array(kept, BYTES)], names=["doc_id", "spans", "kept"]
        )


def without_repeats(
    documents: DataFrame, *, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET
) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, spans (byte runs that go, maximal), kept (the remaining bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text or another,
    overlapping or not; strings are judged on the input.  ``kept`` is binary, since a run may end inside a
    character.  A null text is an empty one; texts shorter than ``length`` stay whole.  Rows that share an id, or are equal, are
    texts of their own, so equal texts of ``length`` bytes or more lose everything.  Texts of any length are read in
    pieces.  Other columns are left out.  An empty table gives no rows.
    """
    if gram & (gram - 1) or not 8 <= gram <= length < 1 << 15:
        raise ValueError("gram: a power of two from 8 to length")
    spark, folder = documents.sparkSession, shared(documents)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = stage(texts.withColumn("row", F.monotonically_increasing_id()), folder, "docs", "zstd")
    long = docs.where(F.octet_length("text") >= length).select("row", "text")
    rows = stage(long.mapInArrow(partial(_dealt, length=length, gram=gram), _ddl(DEALT)), folder, "stretches", "zstd")
    # Buckets met more than once, and whether by different stretches; the others' stretches are not looked at again.
    times = F.sum(F.col("place").bitwiseAND(1) + 1)
    met = rows.where("bucket IS NOT NULL").groupBy("bucket").agg(times.alias("n"), F.min("name").alias("a"), F.max("name").alias("b"), F.min("tail").alias("c"), F.max("tail").alias("d"))
    met = met.where("n > 1").select("bucket", F.expr("a < b OR c < d").alias("mixed"))
    live = rows.where("bucket IS NOT NULL").join(met, "bucket")
    live = stage(live.unionByName(rows.where("bucket IS NULL").withColumn("mixed", F.lit(False))), folder, "live_0", "zstd")
    let_go(spark, f"{folder}/stretches")
    found = [live.where("NOT mixed").select("row", *_windows())]
    rows, level, hot = live.where("mixed"), 0, True
    while hot:
        times = F.sum(F.col("place").bitwiseAND(1) + 1)
        carried = [F.any_value(c).alias(c) for c in ("low", "high", "bytes")] if level else []
        named = rows.groupBy("bucket", "name", "tail").agg(times.alias("n"), F.min(F.struct("row", "place")).alias("first"), *carried)
        named = stage(named, folder, f"named_{level}", "zstd")
        key = ["bucket", "name", "tail"]
        again = rows.join(named.where("n > 1").select(*key), key, "left_semi").select("row", *_windows())
        found.append(stage(again, folder, f"again_{level}", "zstd"))
        sizes = named.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1")
        mixed = named.join(sizes, "bucket").select("bucket", "n", "k", "first.*", *(["low", "high", "bytes"] if level else []))
        if not level:
            cells = F.struct("place", "bucket", "n", "k")
            places = mixed.groupBy("row").agg(F.collect_list(cells).alias("places"))
            mixed = long.join(places, "row").mapInArrow(partial(_cut, length=length), _ddl(PLACED))
            mixed = mixed.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(length - gram + 1).cast("long")})
        mixed = stage(mixed, folder, f"mixed_{level}", "zstd")
        few = gathered(mixed.where(F.col("k") <= bucket).select("bucket", "row", "place", "n", "bytes"), ["bucket"])
        found.append(stage(few.mapInArrow(partial(_sorted, length=length), _ddl(SPANS)), folder, f"sorted_{level}", "zstd"))
        many = mixed.where(F.col("k") > bucket)
        hot = not many.isEmpty()
        level += 1
        if hot:
            rows = stage(many.mapInArrow(partial(_halved, length=length), _ddl(HALVED)), folder, f"halves_{level}", "zstd")
        let_go(spark, f"{folder}/named_{level - 1}", f"{folder}/mixed_{level - 1}")
    spans = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("found"))
    return (
        docs.join(spans, "row", "left")
        .select("doc_id", "text", "found")
        .mapInArrow(partial(_without, length=length), "doc_id long, spans array<struct<start:long,stop:long>>, kept binary")
    )


def suffix_dedup(documents: DataFrame) -> DataFrame:
    """The digests of ``without_repeats``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return without_repeats(documents).select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
