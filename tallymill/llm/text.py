"""Whole texts as byte arrays: word bounds and hashes without a Python loop over words.

Everything here works on one Arrow batch inside a task.  ``chunks`` walks a batch in
pieces of about a megabyte so that temporary arrays stay small whatever the batch holds;
a single longer text is a piece of its own, of which a few flags per byte are kept, and hashes are
made a megabyte at a time.  A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
# An odd multiplier has an inverse modulo 2**64, so a word's hash can be cut out of running sums.
MULTIPLIER = 0x9E3779B97F4A7C15

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Words of letters, digits and all bytes beyond ASCII, after A-Z are lowered.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
# Words between ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Words are hashed modulo two primes below 2**31, so that sums over a megabyte fit 64 bits.  Modulo a power
#: of two, words that collide under any multiplier are known.
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_580_030_173, 1_125_899_839)

_powers: dict[str, np.ndarray] = {}


@dataclass
class Texts:
    """Some consecutive rows of a batch: their bytes one after the other."""

    first: int  # row of the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def row(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # of each row's words, one more than rows
    hashes: np.ndarray  # uint64


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        at, to = offsets[first], offsets[last]
        yield Texts(first, data[at:to], offsets[first : last + 1] - at)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept for the worker's life."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for name, base in (("up", MULTIPLIER), ("down", pow(MULTIPLIER, -1, 1 << 64))):
            line = np.full(size, base, np.uint64)
            line[0] = 1
            _powers[name] = np.multiply.accumulate(line)
    return _powers["up"], _powers["down"]


def word_bounds(texts: Texts, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``kind`` bytes; runs end with their row."""
    inside = kind[texts.data]
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    after = before[1:].copy()
    after[:-1] = inside[1:]
    if len(after):
        after[-1] = False
    cuts = texts.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    after[cuts - 1] = False
    before = before[:-1]
    before[cuts] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hashes(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of short spans that may overlap; both starts and ends rise."""
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = int(np.searchsorted(starts, starts[lo] + CHUNK_BYTES))
        at, to = int(starts[lo]), int(ends[hi - 1])
        up, down = powers(to - at)
        values = texts.data[at:to].astype(np.uint64)
        values += np.uint64(1)
        values *= up[: len(values)]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=sums[1:])
        first = starts[lo:hi] - at
        out[lo:hi] = (sums[ends[lo:hi] - at] - sums[first]) * down[first]
        lo = hi
    return mix(out)


def prime_powers(k: int) -> np.ndarray:
    """Powers of a base modulo its prime, as many as a chunk has bytes."""
    name = f"prime {k}"
    if name not in _powers:
        line = np.ones(1, np.uint64)
        while len(line) < CHUNK_BYTES:
            line = np.concatenate([line, line * np.uint64(pow(BASES[k], len(line), PRIMES[k])) % np.uint64(PRIMES[k])])
        _powers[name] = line
    return _powers[name]


def residues(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The lowered bytes of spans, a chunk's bytes in all at most, as polynomials modulo each prime."""
    first = np.cumsum(sizes) - sizes
    within = np.arange(sizes.sum()) - np.repeat(first, sizes)
    values = LOWER[data[within + np.repeat(starts, sizes)]].astype(np.uint64)
    values += np.uint64(1)
    return [np.add.reduceat(values * prime_powers(k)[within], first) % np.uint64(p) for k, p in enumerate(PRIMES)]


def word_hashes(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the lowered bytes of spans, of which none is empty; memory does not grow with a span."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - sizes[lo] + CHUNK_BYTES, "right")))
        if sizes[lo] <= CHUNK_BYTES:
            high, low = residues(texts.data, starts[lo:hi], sizes[lo:hi])
            out[lo:hi] = (high << np.uint64(32)) | low
        else:
            sums = [0, 0]
            for at in range(0, int(sizes[lo]), CHUNK_BYTES):
                size = min(CHUNK_BYTES, int(sizes[lo]) - at)
                part = residues(texts.data, starts[lo:hi] + at, np.array([size]))
                sums = [(s + pow(b, at, p) * int(x[0])) % p for s, b, p, x in zip(sums, BASES, PRIMES, part)]
            out[lo] = (sums[0] << 32) | sums[1]
        lo = hi
    return mix(out)


def words(texts: Texts, kind: np.ndarray = ALNUM) -> Words:
    """Words of ``kind`` bytes; their hashes are of the lowered bytes."""
    starts, ends = word_bounds(texts, kind)
    return Words(starts, ends, np.searchsorted(starts, texts.offsets), word_hashes(texts, starts, ends))


def hash_words(phrase: str) -> np.ndarray:
    """Hashes of a phrase's words, equal to those of the same words in a text."""
    column = pa.array([phrase])
    return words(next(chunks(column))).hashes if phrase else np.zeros(0, np.uint64)


def shingle_hashes(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``width`` consecutive words and each row's bounds among them.

    A row with fewer words, but at least one, has one shingle of all its words.
    """
    h, bounds = found.hashes, found.bounds
    counts = np.diff(bounds)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out_bounds[1:])
    total = max(0, len(h) - width + 1)
    rolled = np.zeros(total, np.uint64)
    for k in range(width):
        rolled *= np.uint64(MULTIPLIER)
        rolled += h[k : k + total]
    at = np.arange(out_bounds[-1]) + np.repeat(bounds[:-1] - out_bounds[:-1], sizes)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return mix(rolled[at]), out_bounds
    out = np.zeros(len(at), np.uint64)
    usable = np.repeat(counts >= width, sizes)
    out[usable] = rolled[at[usable]]
    for row in short:
        value = 0
        for word in h[bounds[row] : bounds[row + 1]]:
            value = (value * MULTIPLIER + int(word)) % (1 << 64)
        out[out_bounds[row]] = value
    return mix(out), out_bounds


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One list per part."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
