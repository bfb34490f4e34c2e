"""Embedding near-dedup by product quantisation, without loss.

Unit vectors at cosine c are at distance sqrt(2 - 2c), so a link is a distance of at most ``reach``.  A
coarse quantiser deals vectors into inverted lists, and what is left of a vector is coded by its
nearest centroid in each of SUBSPACES subspaces.  A query looks up its distance to a coded vector in tables (the
asymmetric distance).  Both steps keep every link, by the triangle inequality:

* probes: a vector within ``reach`` of a query lies in another list than the query's only if the query is within
  ``reach`` of the plane between the two centroids, so those lists are probed and no others;
* codes: a vector's coding error is stored, and only vectors whose asymmetric distance exceeds ``reach`` plus
  their error are passed over.

What is left is compared by exact cosine in double precision.  Equal vectors are one class from
the start.  Tasks count links and hand on at most an edge per vector, never the pairs.
The quantisers alone are fitted on a bounded sample; any fit gives the same links, a bad one
only more work.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import Batches, components, forest, gathered, groups, shared, stage

THRESHOLD = 0.98
#: Vectors from which the quantisers are fitted.
SAMPLE = 8192
SUBSPACES = 8
CENTROIDS = 256  # per subspace: a code is a byte
#: Vectors of one label that an inverted list should hold, and lists at most.
LIST_SIZE = 2048
LISTS = 1024
#: Vectors and queries in one block.  A query goes to each block of each list it probes, so
#: blocks as large as lists keep its copies few.
BLOCK = 2048
QUERIES = 2048
ROUNDS = 8
SEED = 7


@dataclass
class Quantiser:
    dim: int
    coarse: np.ndarray  # (lists, dim)
    books: np.ndarray  # (SUBSPACES, CENTROIDS, dim / SUBSPACES), zero-padded


def cluster(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from drawn points; an empty cluster keeps its centre."""
    centres = points[rng.choice(len(points), k, replace=len(points) < k)].copy()
    for _ in range(ROUNDS):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.maximum(d, 0)


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squared(points, centres).argmin(1)


def padded(vectors: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors[:, :width]
    return out


def fit(sample: np.ndarray, lists: int) -> Quantiser:
    rng = np.random.default_rng(SEED)
    dim = sample.shape[1]
    part = -(-dim // SUBSPACES)
    wide = padded(sample, part * SUBSPACES)
    coarse = cluster(wide, max(1, min(lists, len(wide))), rng)
    rest = wide - coarse[nearest(wide, coarse)]
    books = [cluster(rest[:, s * part : (s + 1) * part], CENTROIDS, rng) for s in range(SUBSPACES)]
    return Quantiser(part * SUBSPACES, coarse, np.stack(books))


def encode(q: Quantiser, unit: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the residuals and their errors."""
    rest = unit - q.coarse[lists]
    part = q.books.shape[2]
    codes = np.stack([nearest(rest[:, s * part : (s + 1) * part], q.books[s]) for s in range(SUBSPACES)], 1)
    back = np.concatenate([q.books[s][codes[:, s]] for s in range(SUBSPACES)], 1)
    return codes.astype(np.uint8), np.sqrt(((rest - back) ** 2).sum(1))


def probes(q: Quantiser, unit: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
    """(vectors, lists): which lists may hold a vector within reach of each."""
    d = squared(unit, q.coarse)
    between = np.sqrt(squared(q.coarse, q.coarse))[own]
    # distance to the plane between the own centroid and the other
    beyond = d - d[np.arange(len(unit)), own][:, None]
    return beyond <= 2 * between * reach * (1 + 1e-9) + 1e-9


def unit_vectors(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Rows with a usable vector, and the vectors in double precision at length one."""
    rows, out = [], []
    for i, cell in enumerate(column):
        if not cell.is_valid:
            continue
        values = cell.values.cast(pa.float64())
        if values.null_count:
            continue
        v = values.to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            norm = math.sqrt(float(v @ v)) if len(v) else 0.0
        if not np.isfinite(v).all() or not v.any():
            continue
        if not np.isfinite(norm) or norm < 1e-150:  # squares out of range: scale first
            v = v / np.abs(v).max()
            norm = math.sqrt(float(v @ v))
        rows.append(i)
        out.append(v / norm)
    return rows, out


def _classes(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors = unit_vectors(batch.column("embedding"))
        label = batch.column("label").take(pa.array(rows, pa.int64()))
        keys = []
        for name, v in zip(label.to_pylist(), vectors):
            keys.append(hashlib.blake2b(repr((name, len(v))).encode() + (v + 0.0).tobytes(), digest_size=16).digest())
        at = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int32)
        flat = np.concatenate([*vectors, np.zeros(0)])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id").take(pa.array(rows, pa.int64())),
                label,
                pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
            ],
            names=["vec_id", "label", "key", "unit"],
        )


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _placed(batches: Batches, q: Quantiser, reach: float) -> Iterator[pa.RecordBatch]:
    """A coded row per vector for its own list, and a query, without code, per list it must probe."""
    for batch in batches:
        dims = np.array([len(x.values) for x in batch.column("unit")], np.int64)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            part = batch.take(pa.array(rows))
            unit = matrix(part.column("unit"))
            if dim > q.dim:  # of another length than the index: its first dimensions index it
                unit = unit[:, : q.dim]
            wide = padded(unit, q.dim)
            own = nearest(wide, q.coarse)
            asks, lists = np.nonzero(probes(q, wide, own, reach))
            codes, error = encode(q, wide, own)
            code = [c.tobytes() for c in codes]
            for base, which, into in ((True, np.arange(len(rows)), own), (False, asks, lists)):
                for at in range(0, len(which), 4096):
                    some, into_some = which[at : at + 4096], into[at : at + 4096]
                    kept = part.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *kept.columns,
                            pa.array(np.full(len(some), dim, np.int32)),
                            pa.array(into_some.astype(np.int32)),
                            pa.array([code[i] if base else None for i in some], pa.binary()),
                            pa.array(error[some] if base else np.zeros(len(some))),
                        ],
                        names=[*kept.schema.names, "dim", "list", "code", "error"],
                    )


def asymmetric(q: Quantiser, queries: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
    """Distances of queries to coded vectors of a list, from a table per subspace."""
    rest = queries - q.coarse[list_]
    part = q.books.shape[2]
    total = np.zeros((len(queries), len(codes)))
    for s in range(SUBSPACES):
        table = squared(rest[:, s * part : (s + 1) * part], q.books[s])
        total += table[:, codes[:, s]]
    return np.sqrt(total)


def _compare(batches: Batches, q: Quantiser, threshold: float, reach: float) -> Iterator[pa.RecordBatch]:
    key = ["label", "dim", "list", "left", "right"]
    for part in groups(batches, key):
        base = part["code"].is_valid().to_numpy()
        b, a = np.flatnonzero(base), np.flatnonzero(~base)
        if not len(a) or not len(b):
            continue
        unit = matrix(part["unit"])
        wide = padded(unit, q.dim)
        codes = np.frombuffer(b"".join(part["code"].take(pa.array(b)).to_pylist()), np.uint8).reshape(len(b), SUBSPACES)
        error = part["error"].to_numpy()[b]
        names = part["key"].to_pylist()
        copies = part["copies"].to_numpy()
        code_of = {n: i for i, n in enumerate(dict.fromkeys(names))}
        number = np.array([code_of[n] for n in names])
        first = np.zeros(len(code_of), np.int64)
        first[number[::-1]] = np.arange(len(names))[::-1]
        links, xs, ys = np.zeros(len(a), np.int64), [], []
        for at in range(0, len(a), 256):
            some = a[at : at + 256]
            near = asymmetric(q, wide[some], part["list"][0].as_py(), codes) <= reach * (1 + 1e-9) + error[None, :] + 1e-9
            i, j = np.nonzero(near & (number[some][:, None] != number[b][None, :]))
            for to in range(0, len(i), 1 << 16):
                x, y = some[i[to : to + (1 << 16)]], b[j[to : to + (1 << 16)]]
                good = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
                np.add.at(links, i[to : to + (1 << 16)][good] + at, copies[y[good]])
                xs.append(number[x[good]])
                ys.append(number[y[good]])
        some = np.flatnonzero(links)
        if not len(some):
            continue
        label = forest(len(first), np.concatenate(xs), np.concatenate(ys))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[a[i]] for i in some], pa.binary()),
                pa.array(links[some]),
                pa.array([names[first[label[number[a[i]]]]] for i in some], pa.binary()),
            ],
            names=["key", "links", "head"],
        )
        # vectors that only stand as base here are held to the component by their own queries' edges
        joined = np.flatnonzero((label != np.arange(len(label))) & ~np.isin(np.arange(len(label)), number[a[some]]))
        if len(joined):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[first[i]] for i in joined], pa.binary()),
                    pa.array(np.zeros(len(joined), np.int64)),
                    pa.array([names[first[label[i]]] for i in joined], pa.binary()),
                ],
                names=["key", "links", "head"],
            )


def near_vectors(
    embeddings: DataFrame, *, threshold: float = THRESHOLD, sample: int = SAMPLE, list_size: int = LIST_SIZE
) -> DataFrame:
    """One row per row of ``embeddings`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Links join rows of equal label, not null, and equal length with a cosine of at least ``threshold``.
    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with
    nothing.  n_links counts other rows linked directly, so copies count each; component_id is the smallest
    vec_id reachable.  Rows that share a vec_id are vectors of their own.
    """
    folder = shared(embeddings)
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("string").alias("label"),
    )
    usable = rows.where("label IS NOT NULL").mapInArrow(_classes, "vec_id long, label string, key binary, unit array<double>")
    keyed = stage(usable, folder, "keyed")
    classes = keyed.groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("unit").alias("unit")
    )
    classes = stage(classes, folder, "classes")
    many = classes.count()
    linked = None
    if many:
        drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / many)))
        few = [np.array(r["unit"]) for r in classes.where(drawn).select("unit").collect()]
        few = few or [np.array(classes.select("unit").first()["unit"])]
        common = max({len(v) for v in few}, key=lambda d: (sum(len(v) == d for v in few), d))
        largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
        lists = max(1, min(LISTS, -(-largest // list_size)))
        q = fit(np.stack([v for v in few if len(v) == common]), lists)
        reach = math.sqrt(max(0.0, 2 - 2 * threshold))
        asked = classes.select("key", "label", "copies", "unit")
        placed = asked.mapInArrow(
            partial(_placed, q=q, reach=reach),
            "key binary, label string, copies long, unit array<double>, dim int, list int, code binary, error double",
        )
        counts = placed.groupBy("label", "dim", "list").agg(F.count("code").alias("n"), F.count_if(F.col("code").isNull()).alias("m"))
        counts = stage(counts.where("n > 0 AND m > 0"), folder, "lists")
        dealt = placed.join(counts, ["label", "dim", "list"])
        left, right = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"), F.ceil(F.col("m") / F.lit(QUERIES)).cast("int")
        own = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
        every = lambda n: F.sequence(F.lit(0), n - 1)
        dealt = dealt.select(
            "key", "label", "copies", "unit", "dim", "list", "code", "error",
            F.when(F.col("code").isNotNull(), F.array(own(left))).otherwise(every(left)).alias("lefts"),
            F.when(F.col("code").isNotNull(), every(right)).otherwise(F.array(own(right))).alias("rights"),
        )
        dealt = dealt.withColumn("left", F.explode("lefts")).withColumn("right", F.explode("rights")).drop("lefts", "rights")
        met = gathered(dealt, ["label", "dim", "list", "left", "right"]).mapInArrow(
            partial(_compare, q=q, threshold=threshold, reach=reach), "key binary, links long, head binary"
        )
        links = stage(met, folder, "links")
        final = components(links.select(F.col("key").alias("a"), F.col("head").alias("b")), f"{folder}/final")
        final = final.withColumnRenamed("node", "key").join(classes.select("key", "vec_id"), "key")
        heads = stage(final.groupBy("component").agg(F.min("vec_id").alias("component_id")), folder, "heads")
        of = final.join(heads, "component").select("key", "component_id")
        linked = links.groupBy("key").agg(F.sum("links").alias("links")).join(of, "key", "full")
        by_class = classes.select("key", "vec_id", "copies").join(linked, "key", "left")
        by_class = stage(
            by_class.select(
                "key",
                (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"),
            ),
            folder,
            "by_class",
        )
        linked = keyed.select("vec_id", "key").join(by_class, "key").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable_vector()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = alone if linked is None else linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def usable_vector():
    """The rows that ``_classes`` keeps."""
    e = F.col("embedding")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(e, lambda x: F.coalesce(x, F.lit(0.0)) != 0)
    return F.coalesce(F.col("label").isNotNull() & e.isNotNull() & ~odd & ~zero, F.lit(False))
