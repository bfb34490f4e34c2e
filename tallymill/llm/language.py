"""Language identification by cross-parsing entropy.

Per language, a suffix automaton holds a bounded sample of labelled text.  A text is
parsed against each: from every position take the longest match in the sample, go on behind it, and
count the phrases.  The language that needs fewest phrases per character explains the text best.
Phrases are counted over the whole text.  A text is cut into strips that are walked side
by side, one character of all strips and languages at a time, so the walk is a
few array operations per character and not a Python loop per text.

Every letter of the samples has a symbol of its own; letters that no sample holds share one.  A language's table has
columns for the most frequent letters of its own sample, its other transitions are few and stand in a sorted list.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches
from .text import chunks

#: Characters of labelled text in all automata together, and at most per language.
SAMPLE_CHARS = 1 << 20
LANGUAGE_CHARS = 1 << 16
#: Documents per language from which the sample is taken.
SAMPLE_DOCUMENTS = 256
#: Least characters that a drawn text gives.
PART_CHARS = 64
#: Letters of a language with a column in its table; its others are looked up by state and symbol.
LETTERS = 62
STRIP = 512
CHUNK_CHARS = 1 << 21
UNDETERMINED = "und"

_PLANE = 0x110000
MISS = 1 << 30


def _planes() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(_PLANE, dtype=np.uint32)
    letter = np.zeros(_PLANE, bool)
    for i in range(_PLANE):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return lower, letter


LOWER_POINTS, IS_LETTER = _planes()


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray  # of each code point
    column: np.ndarray  # (languages, symbols) of the language's table; all other letters share one
    rare: np.ndarray  # (languages, symbols) whether the sample has it without a column
    first: np.ndarray  # (languages, symbols) state behind the root, with MISS set
    keys: np.ndarray  # sorted state * symbols + symbol of transitions without a column
    went: np.ndarray  # and where they lead
    table: np.ndarray  # state + column -> next state, with MISS set if the match broke
    roots: np.ndarray  # first state of each language


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return moves


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def train(samples: dict[str, str]) -> Model:
    """One automaton per language over its sample."""
    lowered = {k: LOWER_POINTS[points(v)] for k, v in sorted(samples.items())}
    every = np.concatenate([*lowered.values(), np.zeros(0, np.uint32)])
    seen = np.unique(every[IS_LETTER[every]])
    symbol = np.zeros(_PLANE, np.int32)  # 0: no letter
    symbol[IS_LETTER] = len(seen) + 1
    symbol[seen] = np.arange(1, len(seen) + 1)
    symbol = symbol[LOWER_POINTS]
    many = len(seen) + 2
    columns = np.zeros((len(lowered), many), np.int32)
    rare, first = np.zeros((len(lowered), many), bool), np.zeros((len(lowered), many), np.int32)
    tables, roots, base = [], [], 0
    keys, went = [], []
    for k, line in enumerate(lowered.values()):
        symbols = squeeze(symbol[line])
        own, counts = np.unique(symbols, return_counts=True)
        top = own[np.lexsort((own, -counts))][: LETTERS + 1]
        width = len(top) + 1
        columns[k] = len(top)
        columns[k, top] = np.arange(len(top))
        rare[k, own] = columns[k, own] == len(top)
        column, apart = columns[k].tolist(), rare[k].tolist()
        moves = automaton(symbols.tolist())
        if base + len(moves) * width >= MISS:
            raise ValueError("the sample is too large")
        first[k] = base | MISS
        for c, to in moves[0].items():
            first[k, c] = (base + to * width) | MISS
        part = np.empty((len(moves), width), np.int32)
        part[:] = base | MISS
        part[:, :-1] = first[k, top]
        for state, outs in enumerate(moves):
            for c, to in outs.items():
                if apart[c]:
                    keys.append((base + state * width) * many + c)
                    went.append(base + to * width)
                else:
                    part[state, column[c]] = base + to * width
        tables.append(part.ravel())
        roots.append(base)
        base += len(moves) * width
    table = np.concatenate(tables) if tables else np.zeros(1, np.int32)
    order = np.argsort(np.array(keys, np.int64))
    sparse = np.array(keys, np.int64)[order], np.array(went, np.int32)[order]
    return Model(list(lowered), symbol, columns, rare, first, *sparse, table, np.array(roots, np.int32))


def squeeze(symbols: np.ndarray) -> np.ndarray:
    """Runs of what is no letter count as one."""
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    return symbols[keep]


def phrases(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages) phrases of each text's parse, and the texts' symbols.

    A strip starts a phrase of its own, for every language alike.
    """
    rows = [squeeze(model.symbol[points(t)]) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.concatenate([*rows, np.zeros(1, np.int32)]).astype(np.int32)
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    strips = -(-sizes // STRIP)
    owner = np.repeat(np.arange(len(rows)), strips)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(strips) - strips, strips)
    at = begins[owner] + nth * STRIP
    long = np.minimum(sizes[owner] - nth * STRIP, STRIP)
    order = np.argsort(-long, kind="stable")
    at, long, owner = at[order], long[order], owner[order]
    lanes, many = len(at), len(model.languages)
    state = np.repeat(model.roots[:, None], lanes, axis=1)
    count = np.ones((many, lanes), np.int32)
    active = np.searchsorted(-long, -np.arange(1, STRIP + 1), "right")
    for t in range(int(long[0]) if lanes else 0):
        n = active[t]
        now = flat.take(at[:n] + t)
        went = model.table.take(state[:, :n] + model.column.take(now, axis=1))
        if len(model.keys):
            which, lane = np.nonzero(model.rare.take(now, axis=1))
            key = state[which, lane].astype(np.int64) * model.rare.shape[1] + now[lane]
            found = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
            went[which, lane] = np.where(model.keys[found] == key, model.went[found], model.first[which, now[lane]])
        count[:, :n] += went >> 30
        state[:, :n] = went & (MISS - 1)
    total = np.zeros((len(rows), many), np.int64)
    for k in range(many):
        total[:, k] = np.bincount(owner, count[k], len(rows))
    return total, sizes


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    The score is how much shorter the best parse is than the next: 0 on a tie, which the
    first language in order wins, and 1 if there is no other language.
    """
    whole = [t or "" for t in texts]
    lettered = np.array([bool(IS_LETTER[points(t)].any()) and any(map(str.isalpha, t)) for t in whole], bool)
    if not model.languages:
        return [UNDETERMINED] * len(whole), np.zeros(len(whole))
    counts, _ = phrases(model, whole)
    best = counts.argmin(axis=1) if len(whole) else np.zeros(0, int)
    ranked = np.sort(counts, axis=1)
    if len(model.languages) == 1:
        score = np.ones(len(whole))
    else:
        score = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1)
    names = [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered)]
    return names, np.where(lettered, score, 0.0)


def labelled_sample(labelled: DataFrame) -> dict[str, str]:
    """About 2 * SAMPLE_DOCUMENTS different texts per language, drawn by hash, and of each the first characters.

    Different texts are counted first by hash, so that each language draws at its own rate, repeated texts count
    once, and only what is drawn leaves the executors.  A language with no more different texts than
    that gives them all.  The fit alone is bounded: LANGUAGE_CHARS characters per language and SAMPLE_CHARS in all,
    of a text a sixteenth of its language's share (4,096 characters up to 16 languages), PART_CHARS at least.
    With many languages each sample gets shorter, and none is left out.
    """
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL AND text <> ''")
    hashed = usable.select("lang", "text", F.xxhash64("text").alias("hash"))
    counts = {r["lang"]: r["count"] for r in hashed.select("lang", "hash").distinct().groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = min(LANGUAGE_CHARS, SAMPLE_CHARS // len(counts))
    rates = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * SAMPLE_DOCUMENTS / n))])
    drawn = F.pmod("hash", F.lit(1 << 32)) / F.lit(float(1 << 32))
    part = F.substring("text", 1, max(share // 16, PART_CHARS)).alias("part")
    some = hashed.select("lang", "hash", drawn.alias("drawn"), part).where(F.col("drawn") < rates[F.col("lang")])
    rows = some.groupBy("lang", "hash").agg(F.min("drawn").alias("drawn"), F.min("part").alias("part")).collect()
    by: dict[str, list[tuple[float, str]]] = {lang: [] for lang in counts}
    for row in rows:
        by[row["lang"]].append((row["drawn"], row["part"]))
    return {lang: "\n".join(p for _, p in sorted(set(parts)))[:share] for lang, parts in by.items()}


def identify(documents: DataFrame, labelled: DataFrame) -> DataFrame:
    """Every row of ``documents`` with lang_pred and score; columns of those names are replaced.

    Learns from ``labelled`` (text, lang) only, and reads nothing of ``documents`` but
    the text.  Null text and text without a letter: ``und``, score 0.  Without labelled rows every text
    is ``und``.  Rows stay as they are, repeated ones too.
    """
    shared_model = documents.sparkSession.sparkContext.broadcast(train(labelled_sample(labelled)))
    kept = [c for c in documents.columns if c not in {"lang_pred", "score"}]
    frame = documents.select(*[F.col(f"`{c}`") for c in kept])
    fields = [*frame.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def scan(batches: Batches) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        for batch in batches:
            for part in chunks(batch.column("text"), CHUNK_CHARS):
                rows = batch.slice(part.first, len(part))
                names, score = predict(model, [part.row(i).decode("utf-8", "replace") for i in range(len(part))])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(names, pa.string()), pa.array(score)], names=[*rows.schema.names, "lang_pred", "score"]
                )

    return frame.mapInArrow(scan, T.StructType(fields))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def predicted_languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that are not held out."""
    labelled = documents.where(~held_out()).select("text", "lang")
    found = identify(documents.select("doc_id", "text"), labelled)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
