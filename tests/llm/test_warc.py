import hashlib
import zlib

from oracle import connect, differences

from tallymill.llm.queries import ORACLES, QUERIES
from tallymill.llm.warc import coalesced, parse, read_records, warc_round_trip, write_archives
from tallymill.sinks import shared_folder

BIG, OTHER = "<p>é</p>" * 200, "<b>x</b>" * 200
PAGES = [
    (1, "http://a/1", BIG),
    (2, "http://a/2\r\nX: y", BIG),
    (3, None, BIG),
    (4, "http://a/4", "small"),
    (5, "http://a/5", "small"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", OTHER),
    (8, "http://a/8", OTHER),
    (None, "http://a/9", BIG),
    (10, "http://a/10", "x" * 3_000_000),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS keeper")


def test_odd_pages(spark):
    got = warc_round_trip(pages(spark, PAGES)).collect()
    rows = sorted(((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got))
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        revisit = html == BIG and page != 3
        want.append((page or 0, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert rows == sorted(want)
    assert warc_round_trip(pages(spark, [])).collect() == []


def test_index_addresses_single_records(spark):
    folder = shared_folder(spark)
    index = write_archives(pages(spark, PAGES).repartition(3), folder)
    for row in index.collect():
        with open(row["archive"], "rb") as source:
            source.seek(row["offset"])
            headers, body = parse(zlib.decompress(source.read(row["length"]), 31))
        assert headers["WARC-Payload-Digest"] == f"sha1:{row['payload_digest']}"
        assert headers["WARC-Type"] == "revisit" or hashlib.sha1(body).hexdigest() == row["payload_digest"]
        assert "\n" not in headers["WARC-Target-URI"]
    some = {r["page_id"]: bytes(r["payload"]) for r in read_records(index.where("page_id IN (4, 10)"), folder).collect()}
    assert some == {4: b"small", 10: b"x" * 3_000_000}


def test_coalesced_ranges():
    assert coalesced([(0, 10), (10, 5), (30, 5), (200, 1)], gap=20) == [(0, 35, [0, 1, 2]), (200, 201, [3])]
    assert coalesced([]) == []


def test_query(spark, sf_dir):
    assert differences(QUERIES["op3_warc_round_trip"](spark, sf_dir), connect(sf_dir), ORACLES["op3_warc_round_trip"]) == ""
