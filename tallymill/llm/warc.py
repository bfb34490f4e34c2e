"""WARC archives with an index written first, and reads coalesced from it.

Each task writes an archive of gzip members, one per record, to the shared folder and
returns the index rows of what it wrote: archive, offset, length, URL and digest.  Only
the index of a task attempt that succeeded is kept, so an archive left by a lost
executor is never read.  A read takes selected index rows, sorts them by offset, and
fetches neighbours in one byte range.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import Batches, gathered, groups, shared, stage

#: A payload shorter than this is never replaced by a revisit.
LEAST_REVISIT_BYTES = 1000
#: Records that lie in one stretch of this many bytes are read together.
RANGE_BYTES = 4 << 20
#: Bytes between two records that a range read rather fetches than skips.
GAP_BYTES = 64 << 10
#: An archive is closed and the next one begun at this size.
ARCHIVE_BYTES = 256 << 20

INDEX = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def address(folder: str) -> str:
    """The folder as Arrow names it: a bare path is a local one, and s3a is s3."""
    kind, _, rest = folder.partition(":")
    if not rest or kind.startswith("/"):
        return f"file://{folder}"
    if kind == "file":
        return f"file:///{rest.lstrip('/')}"
    return f"s3:{rest}" if kind in ("s3a", "s3n") else folder


def header_value(text: str | None) -> str:
    """A header is one line: line ends inside a value become spaces."""
    return " ".join((text or "").splitlines())


def record(page_id, url, payload: bytes, digest: str, keeper) -> bytes:
    """A response record, or a revisit record without the payload if ``keeper`` is another page."""
    revisit = keeper is not None and keeper != page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {header_value(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{keeper}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if revisit else payload
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record; raises if its length is not what it says."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    return headers, rest[:length]


def pack(raw: bytes) -> bytes:
    squeezer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeezer.compress(raw) + squeezer.flush()


def keepers(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(payload_digest, keeper) of payloads that several records share and that are long enough.

    Combined in the map tasks, so a payload that a third of the pages share is a row per task.
    """
    by = pages.where(F.octet_length("html") >= least).groupBy(F.sha1("html").alias("digest"))
    return by.agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper")


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``; returns the index.

    Null html is an empty payload.  Of equal payloads of at least ``least`` bytes the row with the largest
    page_id is the response and the others are revisits of it; rows that share that id are
    all responses, and so are all if every id is null.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    known = stage(keepers(rows, least), folder, "keepers")
    marked = rows.withColumn("digest", F.sha1("html")).join(known, "digest", "left")

    def write(batches: Batches) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(f"{address(folder)}/archives")
        out, path, size = None, "", 0
        for batch in batches:
            found = []
            columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "keeper")]
            for page_id, url, html, digest, keeper in zip(*[c.to_pylist() for c in columns]):
                if out is None or size >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(root, recursive=True)
                    path, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                member = pack(record(page_id, url, html.encode(), digest, keeper))
                out.write(member)
                found.append((page_id, url, path, size, len(member), digest))
                size += len(member)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*found), ARROW_INDEX)], schema=ARROW_INDEX
                )
        if out is not None:
            out.close()

    return stage(marked.mapInArrow(write, INDEX), folder, "index")


ARROW_INDEX = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def coalesced(spans: list[tuple[int, int]], gap: int = GAP_BYTES) -> list[tuple[int, int, list[int]]]:
    """Byte ranges (start, end, which spans) that cover sorted (offset, length) spans."""
    ranges: list[tuple[int, int, list[int]]] = []
    for i, (offset, length) in enumerate(spans):
        if ranges and offset - ranges[-1][1] <= gap:
            start, end, which = ranges[-1]
            which.append(i)
            ranges[-1] = (start, max(end, offset + length), which)
        else:
            ranges.append((offset, offset + length, [i]))
    return ranges


def read_records(index: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """The records of the given index rows, each checked against its digest.

    Index rows that lie in the same stretch of an archive go to one task, sorted by offset.
    ``payloads=False`` leaves the payload null.
    """
    selected = index.select("archive", "offset", "length", F.floor(F.col("offset") / RANGE_BYTES).alias("stretch"))
    together = gathered(selected, ["archive", "stretch"], ["offset"])

    def read(batches: Batches) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(f"{address(folder)}/archives")
        for part in groups(batches, ["archive", "stretch"]):
            spans = list(zip(part["offset"].to_pylist(), part["length"].to_pylist()))
            rows = []
            with store.open_input_file(part["archive"][0].as_py()) as source:
                for start, end, which in coalesced(spans):
                    block = source.read_at(end - start, start)
                    for i in which:
                        offset, length = spans[i]
                        member = block[offset - start : offset - start + length]
                        rows.append(_row(zlib.decompress(member, 31), payloads))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW_RECORDS)], schema=ARROW_RECORDS
            )

    return together.mapInArrow(read, RECORDS)


ARROW_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _row(raw: bytes, payloads: bool) -> tuple:
    headers, body = parse(raw)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (
        hashlib.sha1(body).hexdigest() != digest or len(body) != int(headers["WARC-Payload-Length"])
    ):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return (
        _page(headers["WARC-Record-ID"]),
        headers.get("WARC-Target-URI", ""),
        int(headers["WARC-Payload-Length"]),
        digest,
        kind,
        _page(headers.get("WARC-Refers-To")),
        body if payloads else None,
    )


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back, and return what the archives say of each."""
    folder = shared(pages)
    index = write_archives(pages, folder)
    found = read_records(index, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
