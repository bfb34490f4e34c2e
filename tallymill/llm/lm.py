"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions.  Every decision has, at every depth 0 to DEPTH of preceding
bytes, a Krichevsky-Trofimov estimate from all training texts, and a node weighs its own
estimate against its children's by how well either codes the training data; so a text's probability mixes all
depths.  The tree has two parts:

* Down to SHALLOW bytes a context byte is one of CLASSES classes (the most frequent bytes have
  one of their own, the boundary too).  That part has CLASSES ** SHALLOW deepest nodes at most whatever the
  corpus, and is weighted on the driver.
* Below, contexts are exact bytes, and their number grows with the corpus.  They stay in Spark tables: nodes of one
  context of SHALLOW + 1 bytes come together in a task (65,536 counts at most), which hands up their
  weights and, once the upper part is known, makes the probability of each n-gram.

Counts cover all training texts: tasks count n-grams and words, and Spark adds them up.  Documents are scored in
blocks: a block lists its different n-grams, these are joined with their probabilities, and
the block's texts meet the result in one task.

A plain word model goes beside it.  Counts of frequent words go to the tasks (their number is
bounded); all other words are joined with their counts, so no word is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches, gathered, let_go, shared, stage
from .text import LOWER, MULTIPLIER, NOT_SPACE, Texts, chunks, words

DEPTH = 5
SHALLOW = 3
CLASSES = 32
BOUNDARY = 255  # no byte of UTF-8; stands before the first byte and, once, after the last
#: At most so many word counts are sent to tasks; the rest is joined.
SENT_WORDS = 1 << 18
#: Distinct keys that a task counts before it hands them on.
HELD_KEYS = 1 << 20
#: Text bytes after which a block of documents is closed; a longer text is a block of its own.
BLOCK_BYTES = 32 << 20
#: N-grams whose contexts a task holds at once, unless those of one short context are more.
HELD_GRAMS = 1 << 13
WORD, GRAM = 0, 1
END_KEY = 0x0E4D_0E4D_0E4D_0E4D


class Counter:
    """Counts of 64-bit keys in bounded memory."""

    def __init__(self, kind: int):
        self.kind, self.keys, self.counts, self.held = kind, [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys.astype(np.uint64))
        self.counts.append(counts.astype(np.int64))
        self.held += len(keys)

    def merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = [keys[first]], [np.add.reduceat(counts, first)]
        self.held = len(first)

    def full(self) -> bool:
        if self.held <= 2 * HELD_KEYS:
            return False
        self.merge()
        return self.held > HELD_KEYS

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        self.merge()
        keys, counts = self.keys[0].view(np.int64), self.counts[0]
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            kind = np.full(len(keys[part]), self.kind, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(keys[part]), pa.array(counts[part])], names=["kind", "key", "n"]
            )
        self.keys, self.counts, self.held = [], [], 0


def grams(texts: Texts) -> np.ndarray:
    """Each predicted byte, in the lowest eight bits, with the DEPTH bytes before it.

    Bytes are lowered and have DEPTH boundaries round each text, of which a text predicts the one at its end.
    """
    bounds = texts.offsets + DEPTH * np.arange(len(texts) + 1)
    line = np.full(len(texts.data) + DEPTH * (len(texts) + 1), BOUNDARY, np.uint8)
    inside = np.ones(len(line), bool)
    for k in range(DEPTH):
        inside[bounds + k] = False
    line[inside] = LOWER[texts.data]
    inside[bounds[1:]] = True
    runs, size = {1: line}, 1
    while 2 * size <= DEPTH + 1:  # of twice as many bytes each time
        first, then = runs[size][:-size], runs[size][size:]
        runs[2 * size] = first.astype(f"u{2 * size}")
        runs[2 * size] <<= 8 * size
        runs[2 * size] |= then
        size *= 2
    key, done = runs[size][: len(line) - DEPTH].astype(np.uint64), size
    while size := size // 2:
        if (DEPTH + 1) & size:
            key <<= 8 * size
            key |= runs[size][done : done + len(key)]
            done += size
    return key[inside[DEPTH:]]


def each_once(keys: np.ndarray) -> np.ndarray:
    """Sorted, each once; ``np.unique`` without counts goes through a hash table that takes several times as long."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class Places:
    """Where keys stand in an array that has each once: a table of open addresses, twice as many as keys at least.

    A probe touches two cache lines, where halving a sorted array touches one per step.
    """

    def __init__(self, keys: np.ndarray):
        self.keys = keys.view(np.uint64)
        self.bits = max(1, (2 * len(keys) - 1).bit_length()) if len(keys) else 1
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._first(self.keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several the last stays
            lost = self.slots[at] != left
            left, at = left[lost], self._next(at[lost])

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(MULTIPLIER)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self.slots) - 1)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        if not len(wanted):
            return np.zeros(0, np.int32)
        at = self._first(wanted)
        found = self.slots[at]
        wrong = np.flatnonzero(self.keys[found] != wanted)
        while len(wrong):
            if (found[wrong] < 0).any():
                raise KeyError("a key that the array lacks")
            at[wrong] = self._next(at[wrong])
            found[wrong] = self.slots[at[wrong]]
            wrong = wrong[self.keys[found[wrong]] != wanted[wrong]]
        return found


def _learn(batches: Batches) -> Iterator[pa.RecordBatch]:
    counters = (Counter(WORD), Counter(GRAM))
    for batch in batches:
        for texts in chunks(batch.column("text")):
            counters[0].add(*np.unique(words(texts, NOT_SPACE).hashes, return_counts=True))
            counters[0].add(np.array([END_KEY], np.uint64), np.array([len(texts)]))
            counters[1].add(*np.unique(grams(texts), return_counts=True))
            for counter in counters:
                if counter.full():
                    yield from counter.out()
    for counter in counters:
        yield from counter.out()


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers: Stirling's series after a shift by 8."""
    shifted = np.ones_like(x)
    for k in range(8):
        shifted *= x + k
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shifted)


def kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return lgamma(a + 0.5) + lgamma(b + 0.5) - math.log(math.pi) - lgamma(a + b + 1.0)


def kt_pairs(pair: np.ndarray) -> np.ndarray:
    """``kt_block`` of the last axis; most nodes have no counts and need no logarithm."""
    out = np.zeros(pair.shape[:-1])
    some = pair.any(-1)
    out[some] = kt_block(pair[some, 0], pair[some, 1])
    return out


def by_bit(counts: np.ndarray, level: int) -> np.ndarray:
    """Zeros and ones of each node ``level`` bits into the byte, from counts of bytes."""
    return counts.reshape(len(counts), 1 << level, 2, 128 >> level).sum(-1)


def at_level(level: int) -> slice:
    """Where a node's values of one level stand in its line of 255."""
    return slice((1 << level) - 1, (2 << level) - 1)


@dataclass
class Tree:
    """The upper part: of a one, what the nodes on a path give, and the weight left to what is below."""

    classes: np.ndarray  # class of a byte
    row: np.ndarray  # of the tables, by the classes of the SHALLOW bytes before
    path: np.ndarray  # (rows, 255)
    left: np.ndarray  # (rows, 255)


def byte_classes(counts: dict[int, int]) -> np.ndarray:
    """0 is shared, 1 is the boundary, the most frequent other bytes have one each."""
    classes = np.zeros(256, np.int64)
    classes[BOUNDARY] = 1
    top = sorted((b for b in counts if b != BOUNDARY), key=lambda b: (-counts[b], b))[: CLASSES - 2]
    for i, b in enumerate(top):
        classes[b] = 2 + i
    return classes


def grow(classes: np.ndarray, context: np.ndarray, byte: np.ndarray, n: np.ndarray, below: list[np.ndarray]) -> Tree:
    """The upper part from counts of (context, byte); a context is its classes in base CLASSES.

    The last byte is the lowest digit, so a node's parent is its number modulo a power of CLASSES.
    ``below`` has the contexts, lines' places and weights of what the deeper nodes code.
    """
    # what each context's row is made from: every seen node of the tree, and one unseen child of each
    seen = [np.unique(context % CLASSES**d) for d in range(SHALLOW + 1)]  # by depth
    seen[0] = np.zeros(1, np.int64)
    place = [np.full(CLASSES**d, -1, np.int64) for d in range(SHALLOW + 1)]
    for d in range(SHALLOW + 1):
        place[d][seen[d]] = np.arange(len(seen[d]))
    counts = []
    for d in range(SHALLOW + 1):
        flat = place[d][context % CLASSES**d] * 256 + byte
        counts.append(np.bincount(flat, n, len(seen[d]) * 256).reshape(-1, 256))
    deeper = np.zeros((len(seen[SHALLOW]), 255))
    deeper[place[SHALLOW][below[0]], below[1]] = below[2]
    every = [seen[d] for d in range(SHALLOW, -1, -1)]
    base = np.concatenate([[0], np.cumsum([len(nodes) for nodes in every])])
    tables = np.zeros((base[-1], 255)), np.zeros((base[-1], 255))
    for level in range(8):
        pair = [by_bit(c, level) for c in counts]
        weighted = deeper[:, at_level(level)]
        keep = [np.zeros(0)] * (SHALLOW + 1)
        for d in range(SHALLOW, -1, -1):
            block = kt_pairs(pair[d])
            both = np.logaddexp(block, weighted)
            keep[d] = np.exp(block - both)
            if d:
                up = np.zeros((len(seen[d - 1]), 1 << level))
                np.add.at(up, place[d - 1][seen[d] % CLASSES ** (d - 1)], both - math.log(2))
                weighted = up
        path, left = np.zeros((1, 1 << level)), np.ones((1, 1 << level))
        for d in range(SHALLOW + 1):
            if d:
                up = place[d - 1][seen[d] % CLASSES ** (d - 1)]
                path, left = path[up], left[up]
            own = (pair[d][:, :, 1] + 0.5) / (pair[d].sum(-1) + 1)
            path, left = path + left * keep[d] * own, left * (1 - keep[d])
            rows = slice(base[SHALLOW - d], base[SHALLOW - d + 1])
            # below a node without the wanted child every bit has probability one half
            tables[0][rows, at_level(level)] = path if d == SHALLOW else path + left * 0.5
            tables[1][rows, at_level(level)] = left if d == SHALLOW else 0
    row = np.zeros(CLASSES**SHALLOW, np.int32)
    contexts = np.arange(CLASSES**SHALLOW)
    for i, d in reversed(list(enumerate(range(SHALLOW, -1, -1)))):
        at = place[d][contexts % CLASSES**d]
        row = np.where(at >= 0, base[i] + at, row).astype(np.int32)
    return Tree(classes, row, *tables)


def class_context(classes: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The classes of the last SHALLOW bytes of exact contexts."""
    out = np.zeros(len(contexts), np.int64)
    for k in range(SHALLOW - 1, -1, -1):
        out = out * CLASSES + classes[(contexts >> (8 * k)) & 255]
    return out


class Deep:
    """Nodes of exact bytes, from all counts (0: asked for only) of some contexts of SHALLOW + 1 bytes."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.byte = keys & 255
        context = keys >> 8
        depths = range(SHALLOW + 1, DEPTH + 1)
        self.ids, self.counts, self.parent = [], [], []
        for d in depths:
            ids, at = np.unique(context & ((1 << (8 * d)) - 1), return_inverse=True)
            self.counts.append(np.bincount(at * 256 + self.byte, n, len(ids) * 256).reshape(-1, 256))
            self.parent.append(np.searchsorted(self.ids[-1], ids & ((1 << (8 * (d - 1))) - 1)) if self.ids else None)
            self.ids.append(ids)
        self.at = at

    def weigh(self, level: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log of what the uppermost nodes code with all below, and of each node the share of its own estimate."""
        weighted = kt_pairs(by_bit(self.counts[-1], level))
        keep = [np.ones_like(weighted)]
        for i in range(len(self.ids) - 2, -1, -1):
            below = np.zeros((len(self.ids[i]), 1 << level))
            np.add.at(below, self.parent[i + 1], weighted)
            block = kt_pairs(by_bit(self.counts[i], level))
            both = np.logaddexp(block, below)
            keep.insert(0, np.exp(block - both))
            weighted = both - math.log(2)
        return weighted, keep

    def log10(self, tree: Tree) -> np.ndarray:
        """log10 probability of each key's byte after its context."""
        out = np.zeros(len(self.byte))
        rows = tree.row[class_context(tree.classes, self.ids[0])]
        for level in range(8):
            _, keep = self.weigh(level)
            path, left = tree.path[rows, at_level(level)], tree.left[rows, at_level(level)]
            for i, share in enumerate(keep):
                if i:
                    path, left = path[self.parent[i]], left[self.parent[i]]
                pair = by_bit(self.counts[i], level)
                path = path + left * share * (pair[:, :, 1] + 0.5) / (pair.sum(-1) + 1)
                left = left * (1 - share)
            one = path[self.at, self.byte >> (8 - level)]
            out += np.log10(np.where((self.byte >> (7 - level)) & 1, one, 1 - one))
        return out


def near(key: str = "key") -> Column:
    """The last SHALLOW + 1 bytes of a key's context."""
    return F.shiftrightunsigned(key, 8).bitwiseAND(F.lit((1 << (8 * (SHALLOW + 1))) - 1))


def by_context(grams: DataFrame) -> DataFrame:
    """(near, key, n): all n-grams of a near context together in a task."""
    return gathered(grams.select(near().alias("near"), "key", "n"), ["near"])


def whole_contexts(batches: Batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of a ``by_context`` frame, cut between near contexts."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        held.append(tuple(batch.column(c).to_numpy() for c in ("near", "key", "n")))
        if sum(len(h[0]) for h in held) < HELD_GRAMS:
            continue
        part = [np.concatenate(x) for x in zip(*held)]
        change = np.flatnonzero(part[0] != part[0][-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield part[1][:cut], part[2][:cut]
        held = [tuple(x[cut:] for x in part)]
    part = [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0)]
    if len(part[0]):
        yield part[1], part[2]


def hand_up(batches: Batches, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per class context and place in its line what the exact nodes below code."""
    for keys, n in whole_contexts(batches):
        deep = Deep(keys, n)
        parts = []
        contexts = class_context(classes, deep.ids[0])
        for level in range(8):
            weighted, _ = deep.weigh(level)
            row, node = np.nonzero(weighted)
            parts.append((contexts[row] * 256 + node + (1 << level) - 1, weighted[row, node]))
        nodes, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.bincount(which, np.concatenate([p[1] for p in parts]), len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(sums)], names=["node", "w"])


def probabilities(batches: Batches, tree) -> Iterator[pa.RecordBatch]:
    for keys, n in whole_contexts(batches):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(Deep(keys, n).log10(tree.value))], names=["key", "log"])


def learn(training: DataFrame, folder: str) -> DataFrame:
    """(kind, key, n): counts of all words, by hash, and n-grams of ``training`` (text)."""
    rows = training.select("text").mapInArrow(_learn, "kind int, key long, n long")
    return stage(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), folder, "counts")


def tree_of(counts: DataFrame) -> Tree:
    """The upper part; only its counts and the sums of what is below come to the driver."""
    found = counts.where(F.col("kind") == GRAM)
    byte = F.col("key").bitwiseAND(255).cast("int")
    by = {r["byte"]: r["n"] for r in found.groupBy(byte.alias("byte")).agg(F.sum("n").alias("n")).collect()}
    classes = byte_classes(by)
    class_of = F.array(*[F.lit(int(c)) for c in classes])
    context = F.lit(0)
    for k in range(SHALLOW, 0, -1):
        digit = F.shiftrightunsigned("key", 8 * k).bitwiseAND(255).cast("int")
        context = context * CLASSES + F.element_at(class_of, digit + 1)
    few = found.groupBy(context.alias("context"), byte.alias("byte")).agg(F.sum("n").alias("n")).toArrow()
    up = by_context(found).mapInArrow(partial(hand_up, classes=classes), "node long, w double")
    sums = up.groupBy("node").agg(F.sum("w").alias("w")).toArrow()
    node = sums["node"].to_numpy().astype(np.int64)
    below = [node // 256, node % 256, sums["w"].to_numpy()]
    return grow(classes, *[few[c].to_numpy().astype(np.int64) for c in ("context", "byte", "n")], below)


def byte_scores(places: Places, logs: np.ndarray, texts: Texts) -> np.ndarray:
    """log10 probability of each text and its end; ``places`` has all n-grams of the texts."""
    sums = np.concatenate([[0.0], np.cumsum(logs[places.of(grams(texts))])])
    ends = np.cumsum(np.diff(texts.offsets) + 1)
    return sums[ends] - sums[ends - np.diff(texts.offsets) - 1]


SCORED = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("sent_known", T.LongType()),
        T.StructField("sent_log", T.DoubleType()),
        T.StructField("rare_words", T.ArrayType(T.LongType())),
        T.StructField("rare_times", T.ArrayType(T.IntegerType())),
        T.StructField("block", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)
#: A document's columns beside its text when a block is scored.
OWN = ("row", "doc_id", "n_bytes", "n_tokens", "sent_known", "sent_log")


def listed(block: int, seen: Counter) -> Iterator[pa.RecordBatch]:
    """Rows without a document that name a block's n-grams."""
    for part in seen.out():
        some = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("key"))
        columns = {"block": pa.array([block], pa.int64()), "keys": some}
        kinds = pa.schema([(f.name, ARROW[f.name]) for f in SCORED.fields])
        yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(1, f.type)) for f in kinds], schema=kinds)


ARROW = {
    **{c: pa.int64() for c in ("row", "doc_id", "n_bytes", "n_tokens", "sent_known", "block")},
    "sent_log": pa.float64(),
    "rare_words": pa.list_(pa.int64()),
    "rare_times": pa.list_(pa.int32()),
    "text": pa.string(),
    "keys": pa.list_(pa.int64()),
}


def _score_block(texts: pa.Table, values: pa.Table) -> pa.Table:
    places, logs = Places(values["key"].to_numpy()), values["log"].to_numpy()
    scores = [np.zeros(0)]
    for column in texts["text"].chunks:
        scores += [byte_scores(places, logs, part) for part in chunks(column)]
    return texts.select(list(OWN)).append_column("score", pa.array(np.concatenate(scores)))


def score_documents(documents: DataFrame, training: DataFrame) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text), learned from ``training`` (text).

    doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte (code length
    of the text and its end per byte, the end counted as one).  Null text is an empty one: one token, its end.
    Without training rows every bit has probability one half.  Repeated rows and null ids get a row each;
    texts are taken whole, however long, other columns of any name are not read, and an empty table gives no row.
    """
    folder = shared(documents)
    counts = learn(training, folder)
    context = documents.sparkSession.sparkContext
    known = counts.where(F.col("kind") == WORD)
    scale = known.groupBy(F.floor(F.log2("n")).alias("scale")).agg(F.count("*").alias("many"), F.sum("n").alias("n")).collect()
    train_tokens, distinct = sum(r["n"] for r in scale), sum(r["many"] for r in scale)
    least, room = 64, SENT_WORDS
    for r in sorted(scale, key=lambda r: -r["scale"]):
        room -= r["many"]
        if room < 0:
            break
        least = r["scale"]
    frequent = known.where(F.col("n") >= F.lit(1 << min(least, 62))).select("key", "n").toArrow()
    keys = frequent["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    sent = context.broadcast((keys[order], np.log10(frequent["n"].to_numpy()[order] + 1.0)))
    ends = known.where(F.col("key") == END_KEY).select("n").collect()
    end_log = math.log10(ends[0]["n"] + 1) if ends else 0.0
    end_known = int(bool(ends))

    def score(batches: Batches) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = block = task.partitionId() << 40
        frequent, logs = sent.value
        seen, held = Counter(GRAM), 0
        for batch in batches:
            for texts in chunks(batch.column("text")):
                rows = len(texts)
                found = words(texts, NOT_SPACE)
                per = np.diff(found.bounds)
                owner = np.repeat(np.arange(rows), per)
                unique, inverse = np.unique(found.hashes, return_inverse=True)
                at = np.minimum(np.searchsorted(frequent, unique), max(0, len(frequent) - 1))
                hit = frequent[at] == unique if len(frequent) else np.zeros(len(unique), bool)
                log = np.where(hit, logs[at] if len(frequent) else 0.0, 0.0)
                sent_known = np.bincount(owner, hit[inverse], rows).astype(np.int64) + end_known
                sent_log = np.bincount(owner, log[inverse], rows) + end_log
                rare = ~hit[inverse]
                pairs, times = np.unique(owner[rare] * len(unique) + inverse[rare], return_counts=True)
                whose, which = np.divmod(pairs, max(1, len(unique)))
                cuts = np.searchsorted(whose, np.arange(rows + 1)).astype(np.int32)
                columns = [
                    pa.array(np.arange(number, number + rows)),
                    batch.column("doc_id").slice(texts.first, rows),
                    pa.array(np.diff(texts.offsets)),
                    pa.array(per + 1),
                    pa.array(sent_known),
                    pa.array(sent_log),
                    pa.ListArray.from_arrays(cuts, pa.array(unique[which].view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    pa.array(np.full(rows, block)),
                    batch.column("text").slice(texts.first, rows),
                    pa.nulls(rows, ARROW["keys"]),
                ]
                number += rows
                own = each_once(grams(texts))
                seen.add(own, np.ones(len(own)))
                held += len(texts.data)
                yield pa.RecordBatch.from_arrays(columns, names=SCORED.names)
                if seen.full() or held > BLOCK_BYTES:
                    yield from listed(block, seen)
                    block, held = block + 1, 0
        yield from listed(block, seen)

    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prepared = stage(frame.mapInArrow(score, SCORED), folder, "prepared", "zstd")
    asked = prepared.where("keys IS NOT NULL").select(F.col("block").alias("of"), F.explode("keys").alias("key"))
    trained = counts.where(F.col("kind") == GRAM).select("key", "n")
    every = trained.unionByName(asked.select("key", F.lit(0).cast("long").alias("n"))).groupBy("key").agg(F.sum("n").alias("n"))
    tree = context.broadcast(tree_of(counts))
    logs = stage(by_context(every).mapInArrow(partial(probabilities, tree=tree), "key long, log double"), folder, "logs")
    let_go(documents.sparkSession)
    values = asked.join(logs, "key").groupBy("of")
    scored = prepared.where("keys IS NULL")
    score_type = T.StructType([*[f for f in SCORED.fields if f.name in OWN], T.StructField("score", T.DoubleType())])
    whole = scored.select(*OWN, "text", "block").groupBy("block").cogroup(values).applyInArrow(_score_block, score_type)
    rare = scored.select("row", F.explode(F.arrays_zip("rare_words", "rare_times")).alias("x")).select(
        "row", F.col("x.rare_words").alias("key"), F.col("x.rare_times").alias("times")
    )
    few = known.where(F.col("n") < F.lit(1 << min(least, 62))).select("key", F.log10(F.col("n") + 1).alias("log"))
    joined = rare.join(few, "key").groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.col("log")).alias("rare_log")
    )
    whole = whole.join(joined, "row", "left")
    rest = F.lit(math.log10(train_tokens + distinct + 1))
    return whole.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("sent_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("sent_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * rest).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))


def scored_corpus(documents: DataFrame) -> DataFrame:
    """All documents scored by what those not held out teach."""
    found = score_documents(documents, documents.where(~held_out()))
    return found.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )
