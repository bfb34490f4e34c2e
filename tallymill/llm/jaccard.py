"""N-gram Jaccard join by chosen paths.

A text is the set of its five-word shingles.  In each of RUNS runs a set chooses few of its
shingles, by a hash and so that a shingle of two similar sets is likely chosen by both, and
goes into the bucket of each.  A bucket of more than SMALL sets is split again: its sets choose again, by a hash of
the path so far, and more of them.  Small buckets are compared by brute force, short sets as they
are and longer ones on sketches, which finds candidates; runs are repeated until a pair at the threshold
meets with the target recall (see ``recall``).

Candidates form groups, and within a group all pairs are compared on their whole sets: that verifies the
candidates and counts every link once, however many buckets a pair met in.  Sets that are equal
are one class from the start, so copies are counted and never compared.  No step
emits the pairs of a group: tasks count, and hand on at most one edge per set.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import Batches, components, forest, gathered, groups, in_blocks, let_go, shared, stage
from .text import MULTIPLIER, chunks, lists, mix, shingle_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
RUNS = 10
#: Shingles that two sets at the threshold are expected to choose both, by depth.  The second choice is made in
#: large buckets only and must make up for pairs that would part there.
RATES = (1.0, 2.0)
DEPTH = len(RATES)
#: Sets in a bucket that is not split further.
SMALL = 256
#: Sets in a block when a bucket or a group is compared; a pair of blocks is what a task holds.
BLOCK = 512
#: Bins of a sketch; each keeps one byte of its least shingle hash.
BINS = 128
#: Standard deviations by which a sketch may underrate a pair before it is passed over.
SLACK = 4.5
#: Sets of at most so many shingles are compared exactly, for few bins of their sketches are in use.
FEW = 48


def recall(runs: int = RUNS, depth: int = DEPTH) -> float:
    """Chance that a pair at the threshold meets in some run, if all its buckets above ``depth`` are large.

    A set of n shingles chooses each with chance rate / (threshold n); the pair's common ones number
    at least threshold times the larger set, so ``rate`` on average are chosen by both, and each is a
    bucket in which the pair must go on to meet.
    """
    meets = 1.0
    for rate in reversed(RATES[:depth]):
        meets = 1 - math.exp(-rate * meets)
    return 1 - (1 - meets) ** runs


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One byte per bin of the hash range, from the least hash in it; 0 where there is none."""
    edges = np.arange(BINS + 1, dtype=np.float64) * (2.0**64 / BINS)
    at = np.searchsorted(tokens, edges[:-1].astype(np.uint64))
    upto = np.append(at[1:], len(tokens))
    out = np.zeros(BINS, np.uint8)
    full = at < upto
    out[full] = (tokens[at[full]] % np.uint64(255)).astype(np.uint8) + 1
    return out


def choose(tokens: np.ndarray, paths: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """New paths, and which of the given ones each goes on from."""
    parents, news = [], []
    step = max(1, (1 << 22) // max(1, len(tokens)))  # bounded memory for a very long text
    for at in range(0, len(paths), step):
        some = paths[at : at + step]
        drawn = (tokens[None, :] ^ some[:, None]) * np.uint64(MULTIPLIER)
        parent, token = np.nonzero(drawn < limit)
        parents.append(parent + at)
        news.append(mix(some[parent] * np.uint64(3) + tokens[token]))
    empty = np.zeros(0, np.int64)
    return np.concatenate([*news, empty.astype(np.uint64)]), np.concatenate([*parents, empty])


def chosen_paths(tokens: np.ndarray, runs: int, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(path, place among the paths one depth above that it goes on from) at each depth."""
    paths = mix(np.arange(1, runs + 1, dtype=np.uint64))
    out = []
    for rate in RATES:
        limit = np.uint64(min(2**64 - 1, int(rate * 2.0**64 / (threshold * len(tokens)))))
        new, parent = choose(tokens, paths, limit)
        out.append((new, parent.astype(np.int32)))
        paths = new
    return out


def _sets(batches: Batches, runs: int, threshold: float, with_sets: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch.column("text")):
            hashes, bounds = shingle_hashes(words(texts), SHINGLE)
            rows, keys, sizes, sketches, tokens, few = [], [], [], [], [], []
            paths: list[list[np.ndarray]] = [[] for _ in range(2 * DEPTH)]
            for i in range(len(texts)):
                own = np.unique(hashes[bounds[i] : bounds[i + 1]])
                if not len(own):
                    continue
                rows.append(i)
                keys.append(digest(own))
                if with_sets:
                    tokens.append(own)
                    continue
                sizes.append(len(own))
                sketches.append(sketch(own).tobytes())
                few.append(own if len(own) <= FEW else own[:0])
                for d, (new, parent) in enumerate(chosen_paths(own, runs, threshold)):
                    paths[2 * d].append(new)
                    paths[2 * d + 1].append(parent)
            kept = batch.slice(texts.first, len(texts)).take(pa.array(rows, pa.int64()))
            if with_sets:
                columns = [*kept.drop_columns(["text"]).columns, pa.array(keys, pa.binary()), lists(tokens, pa.int64())]
                names = [*[n for n in kept.schema.names if n != "text"], "made", "tokens"]
            else:
                columns = [
                    kept.column("doc_id"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    lists(few, pa.int64()),
                    *[lists(p, pa.int32() if i % 2 else pa.int64()) for i, p in enumerate(paths)],
                ]
                names = ["doc_id", "key", "size", "sketch", "few", *PATH_NAMES]
            yield pa.RecordBatch.from_arrays(columns, names=names)


PATH_NAMES = [f"{kind}_{d}" for d in range(1, DEPTH + 1) for kind in ("path", "from")]
SETS = "doc_id long, key binary, size int, sketch binary, few array<long>, " + ", ".join(
    f"{n} array<{'long' if n.startswith('path') else 'int'}>" for n in PATH_NAMES
)


def leaves(sets: DataFrame, folder: str, small: int) -> DataFrame:
    """(path, key, n) of the buckets that are compared, n sets in each.

    Buckets of one set are dropped; those of more than ``small`` are split at the next depth,
    except at the last.
    """
    rows, sizes = [], []
    large = None
    for d in range(1, DEPTH + 1):
        if large is None:
            at = sets.select("key", F.explode("path_1").alias("path"))
        else:
            # sets with a choice in a large bucket, one row each; only these choose again
            chosen = rows[-1].join(large, "path", "left_semi").groupBy("key").agg(F.collect_set("path").alias("held"))
            chosen = stage(chosen, folder, f"chosen_{d}")
            pairs = F.zip_with(
                f"path_{d}", f"from_{d}", lambda p, i: F.struct(p.alias("path"), F.get(f"path_{d - 1}", i).alias("parent"))
            )
            again = sets.select("key", pairs.alias("pairs")).join(chosen, "key")
            held = again.select("key", F.inline(F.filter("pairs", lambda p: F.array_contains("held", p["parent"]))))
            at = held.select("path", "key")
        found = stage(at.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), folder, f"buckets_{d}")
        here = found if d == DEPTH else found.where(F.col("n") <= small)
        rows.append(at)
        sizes.append(here)
        if d < DEPTH:
            # stored apart: they are few, and with their size known Spark can send them to the tasks
            large = stage(found.where(F.col("n") > small).select("path"), folder, f"large_{d}")
            if large.isEmpty():
                break
    members = [r.join(s, "path").select("path", "key", "n") for r, s in zip(rows, sizes)]
    return reduce(DataFrame.unionByName, members)


def _candidates(batches: Batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """Edges that hold together what is similar in a pair of blocks, short sets exactly, others by their sketches."""
    floor = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / BINS)
    firsts: list[bytes] = []
    seconds: list[bytes] = []
    for part in groups(batches, ["path", "left", "right"]):
        if part.num_rows < 2:
            continue
        size = part["size"].to_numpy()
        own = part["own"].to_numpy()
        marks = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
        left, right = part["left"][0].as_py(), part["right"][0].as_py()
        short = np.flatnonzero(size <= FEW)
        place = np.full(len(size), -1)
        place[short] = np.arange(len(short))
        common = overlaps([np.array(part["few"][int(i)].values).view(np.uint64) for i in short]) if len(short) > 1 else None
        a = np.flatnonzero(own == left)
        b = np.flatnonzero(own == right) if right != left else a
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for i in a:
            others = b[b > i] if left == right else b
            if not len(others):
                continue
            fits = np.minimum(size[i], size[others]) >= threshold * np.maximum(size[i], size[others])
            others = others[fits]
            equal = (marks[others] == marks[i]) & (marks[i] != 0)
            used = (marks[others] != 0) | (marks[i] != 0)
            n = used.sum(1)
            good = (equal.sum(1) >= floor * n) | (n < BINS // 4)
            if common is not None and place[i] >= 0:
                exact = np.flatnonzero(place[others] >= 0)
                met = common[place[i], place[others[exact]]]
                good[exact] = met >= threshold * (size[i] + size[others[exact]] - met) - 1e-9
            pairs.append((np.full(good.sum(), i), others[good]))
        if not pairs:
            continue
        x, y = (np.concatenate(z) for z in zip(*pairs))
        label = forest(part.num_rows, x, y)
        joined = np.flatnonzero(label != np.arange(len(label)))
        keys = part["key"].to_pylist()
        firsts += [keys[i] for i in label[joined]]
        seconds += [keys[i] for i in joined]
        if len(firsts) > 10000:
            yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.binary()), pa.array(seconds, pa.binary())], names=["a", "b"])
            firsts, seconds = [], []
    if firsts:
        yield pa.RecordBatch.from_arrays([pa.array(firsts, pa.binary()), pa.array(seconds, pa.binary())], names=["a", "b"])


def overlaps(tokens: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every two sets, a stretch of the shared shingles at a time."""
    flat = np.concatenate(tokens)
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    change = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    times = np.diff(np.append(change, len(flat)))
    several = np.repeat(times > 1, times)
    owner = owner[several]
    column = np.repeat(np.arange((times > 1).sum()), times[times > 1])
    out = np.zeros((len(tokens), len(tokens)), np.float32)
    wide = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        lo, hi = np.searchsorted(column, (at, at + wide))
        matrix = np.zeros((len(tokens), wide), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - at] = 1
        used = np.flatnonzero(matrix.any(1))
        out[np.ix_(used, used)] += matrix[used] @ matrix[used].T
    return out


def _links(batches: Batches, threshold: float) -> Iterator[pa.RecordBatch]:
    """Per set its links in this pair of blocks, weighted by copies, and an edge that holds it to its component."""
    for part in groups(batches, ["component", "left", "right"]):
        keys = part["key"].to_pylist()
        first: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            first.setdefault(key, i)
        which = np.array(sorted(first.values()))  # repeated rows of one document
        if len(which) < 2:
            continue
        tokens = [np.array(part["tokens"][int(i)].values).view(np.uint64) for i in which]
        size = np.array([len(t) for t in tokens], np.float64)
        common = overlaps(tokens)
        own = part["own"].to_numpy()[which]
        left, right = part["left"][0].as_py(), part["right"][0].as_py()
        union = size[:, None] + size[None, :] - common
        linked = common >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if left != right:
            linked &= own[:, None] != own[None, :]
        copies = part["copies"].to_numpy()[which]
        n = linked @ copies.astype(np.float64)
        x, y = np.nonzero(np.triu(linked))
        label = forest(len(which), x, y)
        some = np.flatnonzero(n > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([keys[which[i]] for i in some], pa.binary()),
                pa.array(n[some].astype(np.int64)),
                pa.array([keys[which[label[i]]] for i in some], pa.binary()),
            ],
            names=["key", "links", "head"],
        )


def jaccard_classes(
    documents: DataFrame, *, threshold: float = THRESHOLD, runs: int = RUNS, small: int = SMALL, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, n_links, class_id, kept.

    n_links is the number of other rows whose shingle sets have a Jaccard similarity of at least ``threshold``,
    class_id the smallest doc_id reachable by links, and kept says that it is the row's own.  A text of
    one to four words is a set of one shingle; null texts and texts without a word have none, link
    with nothing and are classes of their own.  Rows that share a doc_id are compared like others; in a
    class whose ids are all null class_id is null, and all of its rows are kept.  Texts are taken whole, however
    long, other columns of any name are not read, and an empty table gives no row.
    """
    folder = shared(documents)
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = stage(frame.mapInArrow(partial(_sets, runs=runs, threshold=threshold, with_sets=False), SETS), folder, "sets")
    # size, sketch and paths are functions of the set, so any of its rows has them
    same = [F.first(c).alias(c) for c in ("size", "sketch", "few", *PATH_NAMES)]
    classes = sets.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), *same)
    classes = stage(classes, folder, "classes")
    sets = stage(sets.select("doc_id", "key"), folder, "keys")
    let_go(documents.sparkSession, f"{folder}/sets")
    rows = leaves(classes, folder, small).join(classes.select("key", "size", "sketch", "few"), "key")
    classes = classes.select("key", "doc_id", "copies")
    dealt = in_blocks(rows, "key", block)
    edges = gathered(dealt, ["path", "left", "right"]).mapInArrow(
        partial(_candidates, threshold=threshold), "a binary, b binary"
    )
    grouped = components(edges, f"{folder}/candidates").withColumnRenamed("node", "key")
    wanted = stage(grouped.join(classes, "key"), folder, "wanted")
    let_go(documents.sparkSession)
    many = stage(wanted.groupBy("component").agg(F.count("*").alias("n")), folder, "groups")
    # by hash at every size: texts are never sorted, and only their ids' partitions are built
    build = wanted.join(many, "component").hint("shuffle_hash").alias("w")
    texts = frame.alias("d").join(build, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
    texts = texts.select("d.text", "w.key", "w.component", "w.copies", "w.n")
    whole = texts.mapInArrow(
        partial(_sets, runs=runs, threshold=threshold, with_sets=True),
        "key binary, component binary, copies long, n long, made binary, tokens array<long>",
    ).where("key = made").drop("made")
    pairs = gathered(in_blocks(whole, "key", block), ["component", "left", "right"])
    links = stage(pairs.mapInArrow(partial(_links, threshold=threshold), "key binary, links long, head binary"), folder, "links")
    linked = links.groupBy("key").agg(F.sum("links").alias("links"))
    final = components(links.select(F.col("key").alias("a"), F.col("head").alias("b")), f"{folder}/final")
    final = final.withColumnRenamed("node", "key").join(classes, "key")
    heads = stage(final.groupBy("component").agg(F.min("doc_id").alias("class_id")), folder, "heads")
    by_class = classes.join(linked, "key", "left").join(
        final.select("key", "component").join(heads, "component").select("key", "class_id"), "key", "left"
    )
    by_class = stage(
        by_class.select(
            "key",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("class_id", "doc_id").alias("class_id"),
        ),
        folder,
        "by_class",
    )
    with_set = sets.select("doc_id", "key").join(by_class, "key").select("doc_id", "n_links", "class_id")
    without = frame.where(~has_word(F.col("text"))).select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id")
    )
    return with_set.unionByName(without).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def has_word(text):
    return F.coalesce(text.rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), F.lit(False))
