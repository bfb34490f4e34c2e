"""Conversation structure repair by generalised LR parsing with weighted edits.

The roles' initials should read ``(s?(ua)+)?``: Talk -> nothing | Turns | s Turns, Turns -> u a | Turns u a.  The parser
shifts rows; each ``u a`` is reduced at once, so a stack is empty, or it ends in s, in u or in Turns, and what lies below
the top never changes what may follow.  All edits are tried side by side, which makes the stacks a graph: per row
the tops alive, each reached by keeping the row, giving it another role, deleting it, or inserting rows before it.  Stacks with
equal tops are merged by the least (cost, audit).  No audit is the beginning of another of equal cost over the same rows
(what follows would be insertions, which cost), so the lesser of two stays the lesser whatever comes after, and merging is exact.

Conversations up to LONG rows are parsed whole in a task.  Longer ones, whatever share of all rows they hold, are
sorted over many tasks; each parses its stretch from every possible top, the stretches' (cost, audit) are put
together in order, and each stretch is then edited by its own part of the audit.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spread import Batches, gathered, shared, stage

# The grammar's initials, the edits' costs.
NAMES = {"u": "user", "a": "assistant"}
RERUN, DROP, ADD, CUT = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Rows of a conversation that one task parses whole.
LONG = 4096
#: Bytes of repaired text that travel as one row to be hashed.
PIECE = 1 << 20

#: What may be shifted on each top: nothing yet, after s, after u, after Turns.
EMPTY, SYSTEM, USER, TURNS = "0SUT"
SHIFT = {
    EMPTY: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": TURNS},
    TURNS: {"u": USER},
}
DONE = (EMPTY, TURNS)
Tops = dict[str, tuple[int, str]]


def _meet(tops: Tops, top: str, found: tuple[int, str]) -> bool:
    """Merge a stack into those of equal top."""
    if top in tops and tops[top] <= found:
        return False
    tops[top] = found
    return True


def inserted(tops: Tops) -> Tops:
    """Also the stacks that inserted rows lead to."""
    out, todo = dict(tops), list(tops)
    while todo:
        top = todo.pop()
        cost, audit = out[top]
        for initial in NAMES:
            to = SHIFT[top].get(initial)
            if to and _meet(out, to, (cost + ADD, audit + "I")):
                todo.append(to)
    return out


def shifted(tops: Tops, initial: str, faulty: bool, cut: bool) -> Tops:
    """The stacks after one more row: deleted, or, unless it must go, kept or given another role."""
    out: Tops = {}
    for top, (cost, audit) in inserted(tops).items():
        _meet(out, top, (cost + DROP, audit + "D"))
        if faulty:
            continue
        cost += CUT * cut
        for wanted, to in SHIFT[top].items():
            if initial == wanted:
                _meet(out, to, (cost, audit + "K"))
            if wanted in NAMES:
                _meet(out, to, (cost + RERUN, audit + "R"))
    return out


class Parse:
    """The stacks over some rows from one top; what all audits have in common is set aside."""

    def __init__(self, start: str = EMPTY):
        self.tops: Tops = {start: (0, "")}
        self.common: list[str] = []

    def row(self, initial: str, faulty: bool, cut: bool) -> None:
        self.tops = shifted(self.tops, initial, faulty, cut)
        if max(len(a) for _, a in self.tops.values()) > 128:
            shared_part = os.path.commonprefix([a for _, a in self.tops.values()])
            self.common.append(shared_part)
            self.tops = {t: (c, a[len(shared_part) :]) for t, (c, a) in self.tops.items()}

    def found(self) -> Tops:
        before = "".join(self.common)
        return {t: (c, before + a) for t, (c, a) in self.tops.items()}


def accepted(tops: Tops) -> tuple[int, str]:
    return min(v for t, v in inserted(tops).items() if t in DONE)


@dataclass
class Counts:
    """What is counted over consecutive rows; two stretches of a conversation add up."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0  # different ones
    least: int | None = None
    most: int | None = None
    first: str | None = None
    last: str | None = None

    def row(self, turn: int | None, initial: str, n: int, fault: str) -> None:
        if fault == "blank":
            self.blank += n
        else:
            self.duplicate += n - 1 + (fault == "duplicate")
            self.truncated += fault == "truncated"
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += n - 1  # equal initials in a row
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.first = initial if self.first is None else self.first
        self.last = initial

    def add(self, other: Counts) -> None:
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if self.last is not None and other.first is not None:
            self.illegal += self.last + other.first not in LEGAL
        if other.least is not None:
            self.turns += other.turns - (other.least == self.most)
            self.least = other.least if self.least is None else self.least
            self.most = other.most
        self.first = other.first if self.first is None else self.first
        self.last = other.last if other.last is not None else self.last

    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


def fault_of(text: str, seen: bool) -> str:
    solid = text.rstrip(BLANKS)
    if not solid:
        return "blank"
    if seen:
        return "duplicate"
    return "" if solid[-1] in ENDS else "truncated"


@dataclass
class Editor:
    """Rows of a conversation edited by an audit, from the top it begins with."""

    audit: str
    top: str = EMPTY
    at: int = 0
    out: list[dict] = field(default_factory=list)

    def _put(self, initial: str, role: str, text: str) -> None:
        self.top = SHIFT[self.top][initial]
        self.out.append({"role": role, "text": text})

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            (initial,) = (i for i in SHIFT[self.top] if i in NAMES)
            self._put(initial, NAMES[initial], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role[:1], role, text)
        elif edit == "R":
            (initial,) = (i for i in SHIFT[self.top] if i in NAMES)
            self._put(initial, NAMES[initial], text)


def _rows(batches: Batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


COUNTED = {n: pa.int64() for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
TURN = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
SUMMARY = {"conv_id": pa.int64(), **COUNTED, "audit": pa.string(), "repaired_sha256": pa.string()}
STRETCH = {
    "conv": pa.string(), "conv_id": pa.int64(), "part": pa.int64(), "counts": pa.string(),
    "top": pa.string(), "to": pa.string(), "cost": pa.int64(), "audit": pa.string(),
}
KINDS = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", TURN: "array<struct<role:string,text:string>>"}


def _ddl(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"`{name}` {KINDS[kind]}" for name, kind in columns.items())


def _batch(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    cells = list(zip(*rows)) or [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, columns.values())], names=list(columns))


def _several(columns: dict[str, pa.DataType], rows: Iterable[tuple], at_once: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield _batch(columns, held)
            held = []
    if held:
        yield _batch(columns, held)


def _summary(conv_id: int | None, counts: Counts, cost: int, audit: str, digest: str) -> tuple:
    return (conv_id, counts.gaps(), counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost, audit, digest)


def _lines(turns: list[dict]) -> list[bytes]:
    return [f"{t['role']}:{t['text']}".encode() for t in turns]


def _whole(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations to their summaries and repaired turns."""

    def found() -> Iterator[tuple]:
        rows = _rows(batches, "conv", "conv_id", "turn", "role", "text", "n")
        for _, group in groupby(rows, key=lambda r: r[0]):
            counts, parse, seen, held = Counts(), Parse(), set(), []
            for _, conv_id, turn, role, text, n in group:
                for _ in range(n):
                    fault = fault_of(text, (role, text) in seen)
                    seen.add((role, text))
                    counts.row(turn, role[:1], 1, fault)
                    parse.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
                    held.append((role, text))
            cost, audit = accepted(parse.found())
            editor = Editor(audit)
            for role, text in held:
                editor.row(role, text)
            editor.insertions()
            digest = hashlib.sha256(b"\n".join(_lines(editor.out))).hexdigest()
            yield (*_summary(conv_id, counts, cost, audit, digest), editor.out)

    yield from _several(SUMMARY | {"turns": TURN}, found())


def _stretches(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows of parts of long conversations to what each part does to the stacks."""

    def found() -> Iterator[tuple]:
        rows = _rows(batches, "conv", "part", "conv_id", "turn", "role", "cut", "blank", "first", "n")
        for (conv, part), group in groupby(rows, key=lambda r: r[:2]):
            counts, parses = Counts(), {top: Parse(top) for top in SHIFT}
            for _, _, conv_id, turn, role, cut, blank, first, n in group:
                fault = "blank" if blank else "duplicate" if not first else "truncated" if cut else ""
                counts.row(turn, role[:1], n, fault)
                for parse in parses.values():
                    parse.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
                    for _ in range(n - 1):
                        parse.row(role[:1], True, False)
            told = repr(tuple(vars(counts).values()))
            for top, parse in parses.items():
                for to, (cost, audit) in parse.found().items():
                    yield conv, conv_id, part, told, top, to, cost, audit

    yield from _several(STRETCH, found(), 16)


PARTS = {"conv": pa.string(), "conv_id": pa.int64(), "part": pa.int64(), "top": pa.string(), "audit": pa.string()} | {
    n: pa.int64() for n in COUNTED
}


def _joined(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Each long conversation's parts in order to the part's own audit, with counts and cost in its last part."""
    from ast import literal_eval

    def found() -> Iterator[tuple]:
        rows = _rows(batches, *STRETCH)
        for conv, group in groupby(rows, key=lambda r: r[0]):
            counts, tops = Counts(), {EMPTY: (0, "")}
            steps: list[tuple[int, dict[str, tuple[str, str]]]] = []
            for part, several in groupby(group, key=lambda r: r[2]):
                nxt: Tops = {}
                came: dict[str, tuple[str, str]] = {}
                for k, (_, conv_id, _, told, top, to, cost, audit) in enumerate(several):
                    if not k:
                        counts.add(Counts(*literal_eval(told)))
                    if top in tops and _meet(nxt, to, (tops[top][0] + cost, tops[top][1] + audit)):
                        came[to] = (top, audit)
                steps.append((part, came))
                tops = nxt
            cost, audit = accepted(tops)
            # The last part's audit also holds the insertions at the end.
            last = next(t for t in tops if accepted({t: tops[t]}) == (cost, audit))
            tail = audit[len(tops[last][1]) :]
            out = []
            for part, came in reversed(steps):
                top, piece = came[last]
                out.append((part, top, piece + tail))
                last, tail = top, ""
            sums = (counts.gaps(), counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost)
            for part, top, piece in reversed(out):
                ends = part == steps[-1][0]
                yield (conv, conv_id, part, top, piece, *(sums if ends else [None] * len(sums)))

    yield from _several(PARTS, found(), 16)


EDITED = {"conv": pa.string(), "conv_id": pa.int64(), "part": pa.int64(), "piece": pa.int64(), "bytes": pa.binary(), "turns": TURN}


def _edited(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows of parts with the part's audit to its repaired turns, some of them at a time."""
    rows = _rows(batches, "conv", "part", "conv_id", "role", "text", "n", "top", "audit")
    for (conv, part), group in groupby(rows, key=lambda r: r[:2]):
        editor, size, piece = None, 0, 0
        for _, _, conv_id, role, text, n, top, audit in group:
            editor = editor or Editor(audit, top)
            for k in range(n):
                editor.row(role, text)
            size += len(text)
            if size >= PIECE:
                yield _batch(EDITED, [(conv, conv_id, part, piece, b"\n".join(_lines(editor.out)), editor.out)])
                editor.out, size, piece = [], 0, piece + 1
        editor.insertions()
        yield _batch(EDITED, [(conv, conv_id, part, piece, b"\n".join(_lines(editor.out)), editor.out)])


def _digests(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per conversation, read as they come."""

    def found() -> Iterator[tuple]:
        for conv, group in groupby(_rows(batches, "conv", "bytes", "many"), key=lambda r: r[0]):
            digest, begun = hashlib.sha256(), False
            for _, data, many in group:
                if many:
                    digest.update((b"\n" if begun else b"") + data)
                    begun = True
            yield conv, digest.hexdigest()

    yield from _several({"conv": pa.string(), "repaired_sha256": pa.string()}, found())


@dataclass
class Repairs:
    """``summary``: a row per conversation; ``turns``: conv_id, part, piece, position, role, text of the repaired rows."""

    summary: DataFrame
    turns: DataFrame


def repair(conversations: DataFrame, *, copies: Column | None = None, long: int = LONG) -> Repairs:
    """Count faults and repair each conversation at least cost; rows are (conv_id, turn, role, text).

    Rows stand in the order of turn (null first), role, text.  A row's first fault counts: blank (no character but white
    space), duplicate (role and text met earlier), truncated (its last character is none of ``.!?``).  gaps is the
    number of turns missing between the least and the largest.  Edits: K keeps (0), R sets role user or assistant (2), D
    deletes (3; a must for blank and duplicate rows), I inserts a row without text (2); truncated rows that stay cost 1.
    audit is the cheapest edits, of equal ones the least.  Only a role's first character counts.

    Null roles and texts read as one space; rows without conv_id are one conversation.  ``copies`` tells how many
    times a row stands there; 0 removes it, but its conversation still has a summary: zeros, an empty audit
    and the digest of nothing.  Equal rows are duplicates of the first.  Texts and conversations may have any length, but an audit is
    one cell.  Other columns are left out.  An empty table gives no rows.
    """
    folder = shared(conversations)
    blank = F.rtrim("text", F.lit(BLANKS))
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("n"),
    )
    rows = stage(rows, folder, "rows")
    sizes = stage(rows.groupBy("conv").agg(F.sum("n").alias("rows")).where(F.col("rows") > long).select("conv"), folder, "long")
    order = ["turn", "role", "text"]
    short = gathered(rows.join(sizes, "conv", "left_anti"), ["conv"], order)
    whole = stage(short.mapInArrow(_whole, _ddl(SUMMARY | {"turns": TURN})), folder, "whole")
    summary = whole.select(*SUMMARY)
    turns = whole.select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("piece"), F.posexplode("turns").alias("position", "turn"))
    if not sizes.isEmpty():
        many = rows.where("n > 0").join(sizes, "conv").groupBy("conv", "conv_id", *order).agg(F.sum("n").alias("n"))
        many = stage(many.withColumn("digest", F.sha2("text", 256)), folder, "many")
        # Where a role and text first stand; a struct, so that a null turn is the least.
        first = many.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("least"))
        marked = many.join(first, ["conv", "role", "digest"]).withColumns({
            "first": F.struct("turn").eqNullSafe(F.col("least")),
            "blank": blank == "",
            "cut": ~F.right(blank, F.lit(1)).isin(*ENDS),
        })
        dealt = marked.drop("digest", "least").repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
        dealt = dealt.withColumns({"part": F.spark_partition_id().cast("long"), "place": F.monotonically_increasing_id()})
        dealt = stage(dealt, folder, "dealt")
        parts = gathered(dealt.drop("text"), ["conv", "part"], ["place"]).mapInArrow(_stretches, _ddl(STRETCH))
        parts = stage(gathered(parts, ["conv"], ["part"]).mapInArrow(_joined, _ddl(PARTS)), folder, "parts")
        audits = parts.select("conv", "part", "top", "audit")
        edited = gathered(dealt.join(audits, ["conv", "part"]), ["conv", "part"], ["place"]).mapInArrow(_edited, _ddl(EDITED))
        edited = stage(edited, folder, "edited")
        pieces = edited.select("conv", "part", "piece", "bytes", F.size("turns").cast("long").alias("many"))
        digests = gathered(pieces, ["conv"], ["part", "piece"]).mapInArrow(_digests, "conv string, repaired_sha256 string")
        joined = parts.groupBy("conv", "conv_id").agg(
            *[F.max(n).alias(n) for n in COUNTED],
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "").alias("audit"),
        )
        summary = summary.unionByName(joined.join(digests, "conv").select(*SUMMARY))
        turns = turns.unionByName(edited.select("conv_id", "part", "piece", F.posexplode("turns").alias("position", "turn")))
    return Repairs(summary, turns.select("conv_id", "part", "piece", "position", "turn.*"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of their id and turn, with ``copies`` telling how many times each stands there."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    cells = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(text("role")).alias("role"),
        cells.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """The summary of ``repair`` for rows damaged on purpose; null roles and texts read as one space before."""
    return repair(damaged(conversations), copies=F.col("copies")).summary
