"""License scan: exact set-similarity join of text blocks with license templates.

A block is a window of twice a template's words.  Windows begin at every word of the template that stands in a
text, so whether a match is found does not hang on where it begins: a window with the most of a template's words can begin
at one.  A block matches a template if it holds at least ``threshold`` of the template's distinct words.  The join is exact:

* length filter: a block with fewer than ``need`` places of template words cannot match;
* prefix filter: words are ordered by their count over all texts, rarest first; a match must hold one of
  the first |T| - need + 1 words of the template;
* positional filter: blocks are compared word by word in that order, and one leaves as soon as
  what it has and the |T| - i - 1 words to come stay below need.

Beside it, base phrases are found wherever their words stand consecutively.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches
from .text import Texts, chunks, hash_words, words

# The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Template texts and their labels; a label may have several.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "licensed under the terms of the gnu general public license as published by the free software foundation"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
)
THRESHOLD = 0.8

FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)
ARROW_FOUND = pa.schema(
    [
        *[(n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")],
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)


@dataclass
class Template:
    label: str
    size: int  # words, so blocks have twice as many
    ranks: np.ndarray  # of its distinct words, rising
    need: int
    prefix: np.ndarray  # ranks of which a match holds at least one


@dataclass
class Plan:
    vocabulary: np.ndarray  # sorted hashes of all template words
    rank: np.ndarray  # of each
    templates: list[Template]


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(size * threshold - 1e-9))


def plan(templates, counts: Mapping[int, int], threshold: float) -> Plan:
    """Templates in the order of the corpus; ``counts`` by hash, 0 where missing."""
    hashed = [(label, hash_words(text)) for label, text in templates]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, h in hashed]]))
    seen = np.array([counts.get(int(v), 0) for v in vocabulary], np.int64)
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.lexsort((vocabulary, seen))] = np.arange(len(vocabulary))
    made = []
    for label, h in hashed:
        if not len(h):
            continue
        ranks = np.sort(rank[np.searchsorted(vocabulary, np.unique(h))])
        need = needed(len(ranks), threshold)
        made.append(Template(label, len(h), ranks, need, ranks[: len(ranks) - need + 1]))
    return Plan(vocabulary, rank, made)


def known_words(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words that are in the vocabulary, and their places in it."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == hashes)
    return hit, at[hit]


def word_counts(documents: DataFrame, templates=TEMPLATES) -> dict[int, int]:
    """How often each template word stands in all texts; the result is as large as the templates."""
    vocabulary = plan(templates, {}, 1.0).vocabulary

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for texts in chunks(batch.column("text")):
                _, which = known_words(words(texts).hashes, vocabulary)
                total += np.bincount(which, minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"]
        )

    rows = documents.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {int(vocabulary[r["word"]]): r["n"] for r in rows.collect()}


def containment(template: Template, at: np.ndarray, ranks: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the template's words at which a matching block begins, and how many of its distinct words each holds.

    ``at`` are the places of known words, ``ranks`` theirs, ``ends`` the ends of the texts they stand in.
    """
    own = np.isin(ranks, template.ranks)
    at, ranks = at[own], ranks[own]
    ends = np.minimum(at + 2 * template.size, ends[own])
    last = np.searchsorted(at, ends)
    rare = np.concatenate([[0], np.cumsum(np.isin(ranks, template.prefix))])
    first = np.arange(len(at))
    left = np.flatnonzero((last - first >= template.need) & (rare[last] > rare[first]))
    common = np.zeros(len(left), np.int64)
    for i, rank in enumerate(template.ranks):
        if not len(left):
            break
        places = np.append(at[ranks == rank], np.iinfo(np.int64).max)
        common += places[np.searchsorted(places, at[left])] < ends[left]
        stays = common + len(template.ranks) - i - 1 >= template.need
        left, common = left[stays], common[stays]
    return at[left], common


def _scan(texts: Texts, known: Plan, phrases: list[tuple[np.ndarray, str]]) -> list[list]:
    """Columns of the result but doc_id."""
    found = words(texts)
    h, bounds = found.hashes, found.bounds
    rows = len(texts)
    n_base = np.zeros(rows, np.int64)
    first, last = np.full(rows, -1, np.int64), np.full(rows, -1, np.int64)
    base: dict[int, set[str]] = {}
    labels: dict[int, set[str]] = {}
    score = np.zeros(rows)
    for phrase, label in phrases:
        k = len(phrase)
        anchor = k // 2
        at = np.flatnonzero(h == phrase[anchor]) - anchor
        at = at[(at >= 0) & (at + k <= len(h))]
        for i in range(k):
            at = at[h[at + i] == phrase[i]]
        row = np.searchsorted(bounds, at, "right") - 1
        inside = at + k <= bounds[row + 1]
        for place, r in zip((at - bounds[row])[inside].tolist(), row[inside].tolist()):
            n_base[r] += 1
            first[r] = place if first[r] < 0 else min(first[r], place)
            last[r] = max(last[r], place)
            base.setdefault(r, set()).add(label)
            score[r] = 1.0
    at, which = known_words(h, known.vocabulary)
    ranks = known.rank[which]
    row = np.searchsorted(bounds, at, "right") - 1
    for template in known.templates:
        begins, common = containment(template, at, ranks, bounds[row + 1])
        matched = np.searchsorted(bounds, begins, "right") - 1
        np.maximum.at(score, matched, common / len(template.ranks))
        for r in np.unique(matched).tolist():
            labels.setdefault(r, set()).add(template.label)
    return [
        np.diff(bounds).tolist(),
        n_base.tolist(),
        [None if x < 0 else x for x in first.tolist()],
        [None if x < 0 else x for x in last.tolist()],
        [",".join(sorted(base.get(r, ()))) for r in range(rows)],
        [",".join(sorted(base.get(r, set()) | labels.get(r, set()))) for r in range(rows)],
        score.tolist(),
    ]


def license_scan(
    documents: DataFrame, *, templates=TEMPLATES, phrases: Mapping[str, str] = PHRASES, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; no other column is read).

    Null text counts as empty: no words, no labels, score 0.  The score is 1 where a base phrase stands,
    else the largest share of a template found in a block, or 0 below the threshold.
    Repeated rows and null ids give a row each.
    """
    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = plan(templates, word_counts(frame, templates), threshold)
    hashed = [(hash_words(p), label) for p, label in phrases.items()]

    def scan(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(texts.first, len(texts))
                columns = _scan(texts, known, hashed)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, f.type) for c, f in zip(columns, list(ARROW_FOUND)[1:])]], schema=ARROW_FOUND
                )

    return frame.mapInArrow(scan, FOUND)
