"""Pack token sequences: first-fit decreasing in randomised groups.

Documents become ids once.  Pieces of full length fill a sequence each; what remains of a document
is an item, and items are dealt at random into groups of bounded size.  Within a group items go, longest
first, into the first bin with room, which a tournament tree over the bins' room
finds in log n steps.  Groups are independent, so nothing larger than one group is
ever in one task, and since a group holds thousands of items hardly any room stays empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches, shared, stage
from .text import NOT_SPACE, Texts, chunks, mix, word_bounds, word_hashes

SEQUENCE = 4096
END_ID = 2
GROUP_PIECES = 8192
#: Units a worker remembers, and units encoded at once.
CACHED_UNITS = 600_000
JOINED = 1000

SPACE, LETTER, DIGIT, QUOTE, OTHER, HIGH = range(6)
UNIT_KIND = np.full(256, OTHER, np.uint8)
UNIT_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
UNIT_KIND[48:58] = DIGIT
UNIT_KIND[65:91] = UNIT_KIND[97:123] = LETTER
UNIT_KIND[39] = QUOTE
UNIT_KIND[128:] = HIGH

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("salt", T.LongType()),
    ]
)


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def unit_bounds(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of units that the vocabulary's pre-tokenizer never joins.

    White space always parts.  Between ASCII bytes so do a letter and what is no letter, and a digit
    and anything; an apostrophe may begin a unit with what follows it, so nothing is cut behind one.
    """
    kind = UNIT_KIND[texts.data]
    starts, ends = word_bounds(texts, NOT_SPACE)
    before, after = kind[:-1], kind[1:]
    ascii_pair = (before < HIGH) & (after < HIGH) & (before > SPACE) & (after > SPACE)
    differs = ((before == LETTER) != (after == LETTER)) | (before == DIGIT) | (after == DIGIT)
    inner = np.flatnonzero(ascii_pair & differs & (before != QUOTE)) + 1
    cuts = np.zeros(len(texts.data) + 1, bool)
    cuts[inner] = True
    cuts[texts.offsets] = False
    cuts[starts] = False
    inner = np.flatnonzero(cuts)
    return np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))


class UnitIds:
    """Ids of units, each encoded once while it stays in a bounded cache of sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(names.values()) + 1, bool)
        for name, code in names.items():
            self.closes[code] = name.endswith("</w>")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clock = 0
        self.keys, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each unit one after the other, and how many each has.

        Units of letters are one pre-token each, so many are encoded as one text and told
        apart by the ids that close a word.
        """
        sizes = np.zeros(len(units), np.int64)
        parts: list[np.ndarray] = []
        order: list[int] = []
        plain = [i for i, u in enumerate(units) if u.isalpha()]
        odd = [i for i, u in enumerate(units) if not u.isalpha()]
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            code = self.tokenizer.encode_batch_fast([" ".join(units[i] for i in some)], add_special_tokens=False)
            ids = np.array(code[0].ids, np.uint32)
            closes = np.flatnonzero(self.closes[ids]) + 1
            if len(closes) != len(some):
                odd += some
                continue
            sizes[some] = np.diff(closes, prepend=0)
            parts.append(ids)
            order += some
        for at in range(0, len(odd), JOINED):
            some = odd[at : at + JOINED]
            for i, code in zip(some, self.tokenizer.encode_batch_fast([units[i] for i in some], add_special_tokens=False)):
                parts.append(np.array(code.ids, np.uint32))
                sizes[i] = len(parts[-1])
            order += some
        flat = np.concatenate([*parts, np.zeros(0, np.uint32)])
        from_ = np.zeros(len(units), np.int64)
        from_[order] = np.cumsum(sizes[order]) - sizes[order]
        return ragged(flat, from_, sizes), sizes

    def make_room(self, many: int) -> None:
        """If too many units would be held, those not met for longest go."""
        if len(self.keys) + many > CACHED_UNITS:
            keep = self.used > np.sort(self.used)[max(0, len(self.used) - CACHED_UNITS // 2)]
            self.flat = ragged(self.flat, self.starts[keep], self.sizes[keep])
            self.keys, self.used, self.sizes = self.keys[keep], self.used[keep], self.sizes[keep]
            self.starts = np.cumsum(self.sizes) - self.sizes

    def learn(self, keys: np.ndarray, units: list[str]) -> None:
        flat, sizes = self.encode(units)
        starts = np.cumsum(sizes) - sizes + len(self.flat)
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.used = np.concatenate([self.used, np.full(len(keys), self.clock, np.int32)])[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        self.flat = np.concatenate([self.flat, flat])

    def rows(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and each row's bounds."""
        raw = texts.data.tobytes()
        if any(s in raw for s in self.special):
            whole = [texts.row(i).decode("utf-8", "replace") for i in range(len(texts))]
            ids = [np.array(c.ids, np.uint32) for c in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        self.clock += 1
        starts, ends = unit_bounds(texts)
        hashes = word_hashes(texts, starts, ends)
        unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys):
            self.make_room(len(unique))
        new = np.flatnonzero(~self.known(unique))
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self.learn(unique[new], [raw[s:e].decode("utf-8", "replace") for s, e in spans])
        at = np.searchsorted(self.keys, unique)
        self.used[at] = self.clock
        sizes = self.sizes[at][inverse]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return ragged(self.flat, self.starts[at][inverse], sizes), bounds[np.searchsorted(starts, texts.offsets)]

    def known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


_coders: dict[str, UnitIds] = {}


def coder_of(path: str) -> UnitIds:
    """One per worker, which serves many tasks."""
    if path not in _coders:
        _coders[path] = UnitIds(path)
    return _coders[path]


def _pieces(batches: Batches, path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    coder = coder_of(path)
    context = TaskContext.get()
    counter = (context.partitionId() if context else 0) << 40
    tail = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for texts in chunks(batch.column("text")):
            ids, bounds = coder.rows(texts)
            names = batch.column("doc_id").slice(texts.first, len(texts)).to_pylist()
            rows = []
            for i, doc in enumerate(names):
                code = ids[bounds[i] : bounds[i + 1]].astype("<u4", copy=False).tobytes() + tail
                total = len(code) // 4
                for start in range(0, total, size):
                    part = code[start * 4 : (start + size) * 4]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            salts = mix(np.arange(counter, counter + len(rows), dtype=np.uint64)).view(np.int64)
            counter += len(rows)
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in columns], pa.array(salts)], names=PIECES.names
            )


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; ``lengths`` must not increase."""
    n = len(lengths)
    size = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * size)  # tree[k]: most room of any bin below node k
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, length in enumerate(lengths.tolist()):
        k = 1
        while k < size:
            k *= 2
            if tree[k] < length:
                k += 1
        bins[i], offsets[i] = k - size, capacity - tree[k]
        tree[k] -= length
        while k > 1:
            k //= 2
            room = max(tree[2 * k], tree[2 * k + 1])
            if tree[k] == room:
                break
            tree[k] = room
    return bins, offsets


def _pack(rows: pa.Table, capacity: int) -> pa.Table:
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("salt", "ascending")])
    bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
    sequences = rows["packing_group"].to_numpy() * (1 << 32) + bins
    kept = rows.drop_columns(["salt", "packing_group"])
    return kept.append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))


def pack_documents(
    documents: DataFrame,
    *,
    path: str | None = None,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``documents`` has doc_id and text; other columns are not read.  A document's ids are
    those of its text (null: empty) and then ``end_id``, so an empty text is one piece of one id.
    Pieces are cut every ``sequence`` ids; a document so long that it fills sequences
    gives its full pieces one each.  Repeated rows and null ids are documents of their own.
    Groups are drawn from a number stored with each piece, so a retried task draws the same.
    """
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = partial(_pieces, path=path or vocabulary_file(), size=sequence, end_id=end_id)
    pieces = stage(frame.mapInArrow(cut, PIECES), shared(documents), "pieces")
    many = max(1, -(-pieces.count() // group_pieces))
    out = T.StructType([*PIECES.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    grouped = pieces.withColumn("packing_group", F.pmod(F.col("salt"), F.lit(many)))

    def pack(rows: pa.Table) -> pa.Table:
        return _pack(rows, sequence)

    return grouped.groupBy("packing_group").applyInArrow(pack, out)
