"""Secret scan with multipart credential linking.

Three strong kinds (``assign``, ``access``, ``hex``) are reported wherever they stand.
Weak candidates (account names, endpoints, long opaque words) mean little alone; each is a
part of a credential, and it is reported only if a complementary part stands in the
same scope: parts of a text are joined on intervals, each widened by ``reach`` code points and cut off at
blank lines.  A text is one row, so the join needs no shuffle: parts
are sorted and each asks for the nearest part of a complementary role, which is n log n in
their number, whatever a text holds.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches
from .text import chunks, word_bounds

# Fixed patterns of the base spans.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]+", re.ASCII)
LEAST = {"assign": 8, "access": 16, "hex": 32}
BASE_KINDS = ("assign", "access", "hex")

# Weak candidates.
ACCOUNT = re.compile(
    r"""\b(?i:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""",
    re.ASCII,
)
ADDRESS = re.compile(
    r"""\b(?:[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{2,5})?)""", re.ASCII
)
# A run of host characters with a port; a run is read once, whatever it holds.
HOST_RUN = re.compile(r"[a-z0-9.-]+(?=(:[0-9]{2,5}\b)?)", re.ASCII)
WORD_CHARACTER = re.compile(r"\w", re.ASCII)
OPAQUE = re.compile(r"[A-Za-z0-9+/]+", re.ASCII)
OPAQUE_LEAST = 40
KINDS = (*BASE_KINDS, "account", "endpoint", "opaque")
ROLE = {
    "assign": "secret",
    "hex": "secret",
    "opaque": "secret",
    "access": "identity",
    "account": "identity",
    "endpoint": "endpoint",
}
COMPLEMENTS = {
    "secret": ("identity", "endpoint"),
    "identity": ("secret",),
    "endpoint": ("secret",),
}
REACH = 200
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

HEX_BYTES = np.zeros(256, bool)
HEX_BYTES[[*b"0123456789abcdef"]] = True
OPAQUE_BYTES = np.zeros(256, bool)
OPAQUE_BYTES[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"]] = True

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Strong kinds, leftmost and non-overlapping per kind; a match that is too short is consumed."""
    found = [
        ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= LEAST["assign"]
    ]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        least = LEAST[kind]
        found += [(kind, *m.span()) for m in pattern.finditer(text) if m.end() - m.start() >= least]
    return found


def _host_start(text: str, start: int, end: int) -> int | None:
    """Where the leftmost host that ends at ``end`` begins: labels with dots between them, from a word boundary on."""
    start = max(start, text.rfind("..", start, end) + 1)
    start += text[start:end].startswith(".")
    dot = text.rfind(".", start, end)
    if dot == end - 1:
        return None
    for i in range(start, dot):
        before = i > 0 and WORD_CHARACTER.match(text[i - 1]) is not None
        if text[i] != "." and before != (text[i] != "-"):
            return i
    return None


def endpoints(text: str) -> list[Span]:
    """URLs, IPv4 addresses, and hosts with a port, leftmost and non-overlapping; where several begin, the first of these."""
    found: list[Span] = []
    runs = [(m.start(), m.end(), m.end(1)) for m in HOST_RUN.finditer(text) if m.group(1)]
    at, run, address = 0, 0, ADDRESS.search(text)
    while True:
        while address is not None and address.start() < at:
            address = ADDRESS.search(text, at)
        host = None
        while run < len(runs) and host is None:
            first, end, port = runs[run]
            start = _host_start(text, max(first, at), end) if at < end else None
            if start is None:
                run += 1
            else:
                host = (start, port)
        if address is not None and (host is None or address.start() <= host[0]):
            found.append(("endpoint", *address.span()))
        elif host is not None:
            found.append(("endpoint", *host))
        else:
            return found
        at = found[-1][2]


def weak_spans(text: str) -> list[Span]:
    found = [("account", *m.span()) for m in ACCOUNT.finditer(text)]
    found += endpoints(text)
    found += [
        ("opaque", *m.span()) for m in OPAQUE.finditer(text) if m.end() - m.start() >= OPAQUE_LEAST
    ]
    return found


def linked_spans(text: str, strong: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """The weak spans with a complementary part in their scope.

    Two parts meet if fewer than ``reach`` + 1 code points lie between them and no blank
    line does.  A weak span that lies inside a strong one is part of it and left out.
    """
    covered = sorted((s, e) for _, s, e in strong)
    ends: list[int] = []
    for _, e in covered:
        ends.append(max(e, ends[-1] if ends else e))
    starts = [s for s, _ in covered]

    def inside(start: int, end: int) -> bool:
        i = bisect.bisect_right(starts, start)
        return bool(i) and ends[i - 1] >= end

    weak = [x for x in weak if not inside(x[1], x[2])]
    blanks = [m.start() for m in BLANK_LINE.finditer(text)] if weak else []
    lines: dict[tuple[str, int], tuple[list[int], list[int]]] = {}
    for kind, start, end in sorted([*strong, *weak], key=lambda x: x[1]):
        scope = bisect.bisect_right(blanks, start)
        at, upto = lines.setdefault((ROLE[kind], scope), ([], []))
        at.append(start)
        upto.append(max(end, upto[-1] if upto else end))

    def meets(kind: str, start: int, end: int) -> bool:
        scope = bisect.bisect_right(blanks, start)
        for role in COMPLEMENTS[ROLE[kind]]:
            at, upto = lines.get((role, scope), ((), ()))
            i = bisect.bisect_right(at, start)
            if i < len(at) and at[i] - end <= reach or i and start - upto[i - 1] <= reach:
                return True
        return False

    return [x for x in weak if meets(*x)]


def suspects(texts) -> np.ndarray:
    """Rows that may hold a secret: the patterns run on these alone, and lose nothing by it."""
    rows = np.zeros(len(texts), bool)
    for kind, least in ((HEX_BYTES, LEAST["hex"]), (OPAQUE_BYTES, OPAQUE_LEAST)):
        starts, ends = word_bounds(texts, kind)
        long = starts[ends - starts >= least]
        rows[np.searchsorted(texts.offsets, long, "right") - 1] = True
    return rows


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    order = {k: i for i, k in enumerate(kinds)}
    ranked = sorted(spans, key=lambda x: (x[1], order[x[0]], x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ranked)


def _scan(batches: Batches, reach: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch.column("text")):
            odd = suspects(texts)
            base, every, clean = [], [], []
            for i in range(len(texts)):
                text = texts.row(i).decode("utf-8", "replace")
                lower = text.lower()
                strong: list[Span] = []
                linked: list[Span] = []
                if odd[i] or "AKIA" in text or any(k in lower for k in KEYWORDS):
                    strong = base_spans(text)
                    linked = linked_spans(text, strong, weak_spans(text), reach)
                base.append(strong)
                every.append([*strong, *linked])
                clean.append(text)
            kept = batch.slice(texts.first, len(texts)).drop_columns(["text"])
            yield pa.RecordBatch.from_arrays(
                [
                    *kept.columns,
                    pa.array(clean, pa.string()),
                    *[pa.array([sum(k == kind for k, _, _ in x) for x in base], pa.int64()) for kind in BASE_KINDS],
                    pa.array([joined(x, BASE_KINDS) for x in base], pa.string()),
                    pa.array([joined(x, KINDS) for x in every], pa.string()),
                    pa.array([redacted(t, x) for t, x in zip(clean, every)], pa.string()),
                ],
                names=[*kept.schema.names, "text", *[f"n_{k}" for k in BASE_KINDS], "base_spans", "spans", "clean"],
            )


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span but endpoints replaced by [kind]; overlapping spans are one hole."""
    out, at = [], 0
    for kind, start, end in sorted((x for x in spans if x[0] != "endpoint"), key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def scan_secrets(documents: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """Every row of ``documents`` with its spans and its text without them.

    Adds n_assign, n_access, n_hex, base_spans, spans (text, ``kind:start:end`` joined by
    commas, code points, end exclusive) and clean; columns of those names are
    replaced.  Null text counts as empty: no spans, clean is empty.  Rows stay as they
    are otherwise, repeated ones and null ids too; an empty table gives an empty one.
    """
    added = [*[f"n_{k}" for k in BASE_KINDS], "base_spans", "spans", "clean"]
    kept = [c for c in documents.columns if c not in {*added, text, "text"}]
    frame = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("text"))
    fields = [*frame.select(*[f"`{c}`" for c in kept]).schema.fields, T.StructField("text", T.StringType())]
    fields += [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS]
    fields += [T.StructField(c, T.StringType()) for c in ("base_spans", "spans", "clean")]
    found = frame.mapInArrow(partial(_scan, reach=reach), T.StructType(fields))
    return found.withColumnRenamed("text", text)


def secret_digests(documents: DataFrame) -> DataFrame:
    found = scan_secrets(documents.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
