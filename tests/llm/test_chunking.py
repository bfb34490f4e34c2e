import collections
import random

import pyarrow as pa
from fixtures import LONG, ODD, documents, prose, table

from tallymill.llm import chunking
from tallymill.llm.chunking import GEAR, LEAD, LEAST_BYTES, REACH, STRETCH, WINDOW, _stretches, cut_places, digested, repeated_spans
from tallymill.llm.queries import QUERIES
from tallymill.llm.spread import stage
from tallymill.llm.text import chunks


def cuts(text):
    return set(cut_places(next(chunks(pa.array([text])))).tolist())


def test_an_insertion_moves_only_the_cuts_beside_it():
    text = prose(5, 2000)
    inserted = text[:3000] + "INSERTED" + text[3000:]
    a, b = cuts(text.encode().decode()), cuts(inserted)
    at = len(text[:3000].encode())
    assert {c for c in a if c <= at - REACH} == {c for c in b if c <= at - REACH}
    assert {c + 8 for c in a if c > at + LEAD + REACH} == {c for c in b if c > at + 8 + LEAD + REACH}
    assert 10 < len(text.encode()) / len(a) < 25
    digests = lambda t: {int(d) for d in digested(next(chunks(pa.array([t]))))[3]}
    assert len(digests(text) - digests(inserted)) <= 8 and len(digests(inserted) - digests(text)) <= 9


def test_texts_are_cut_by_themselves():
    texts = [prose(i, 80) for i in range(6)] + ["", "x"]
    part = next(chunks(pa.array(texts)))
    found = cut_places(part)
    for i, t in enumerate(texts):
        lo, hi = part.offsets[i], part.offsets[i + 1]
        assert {int(c - lo) for c in found if lo < c <= hi} == (cuts(t) if t else set())
        places = sorted(cuts(t)) if t else []
        assert all(0 < b - a <= REACH for a, b in zip(places, places[1:])) and all(c >= LEAD for c in places)


def test_odd_documents(spark):
    passage = prose(42, 60)
    docs = [
        *ODD,
        (20, prose(20, 300) + " " + passage + " " + prose(21, 300)),
        (21, passage + prose(22, 50)),
        (22, prose(23, 500)),
        (23, "x" * 100_000),
    ]
    got = repeated_spans(documents(spark, docs, digest=1, start="s", row=2)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert {20, 21, 7, 8} == set(by)  # rows of one id are one document; 8 repeats 7
    texts = {d: (t or "").encode() for d, t in docs}
    for r in got:
        assert r["first_doc_id"] <= r["doc_id"] and r["kept"] == (r["first_doc_id"] == r["doc_id"])
        part = texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] >= 96
    assert all(r["kept"] for r in by[20]) and not any(r["kept"] for r in by[21])
    covered = by[21][0]
    assert texts[21][covered["start"] : covered["start"] + covered["length"]] in passage.encode()
    assert repeated_spans(documents(spark, [])).collect() == [] and LONG


def test_query_catches_every_long_passage(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    seen = collections.defaultdict(set)
    for d, t in texts.items():
        w = t.split()
        for i in range(len(w) - 50):
            seen[tuple(w[i : i + 51])].add(d)
    planted = set().union(*[v for v in seen.values() if len(v) > 1])
    got = QUERIES["op5_substring_dedup"](spark, sf_dir).collect()
    found = {r["doc_id"] for r in got}
    assert len(planted & found) >= 0.98 * len(planted)
    # what is reported does stand in another document
    for r in got:
        if not r["kept"] and r["chunks"] == 1:
            part = texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["length"]]
            assert part in texts[r["first_doc_id"]].encode()


def test_equal_stretches_have_an_equal_chunk():
    rng = random.Random(3)
    for seed in range(400):
        size = rng.choice([2, 4, 26])
        line = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz"[:size]) for _ in range(n))  # noqa: B023, E731
        period = line(rng.randint(1, 40))
        stretch = (period * 100)[:STRETCH] if seed % 2 else line(STRETCH)
        heads = [line(rng.randint(0, 60)) for _ in range(2)]
        texts = next(chunks(pa.array([h + stretch + line(rng.randint(0, 60)) for h in heads])))
        rows, starts, ends, digest = digested(texts)
        seen = [
            {(a - lo, d) for r, a, b, d in zip(*(x.tolist() for x in (rows, starts, ends, digest))) if r == i and lo <= a and b <= lo + STRETCH}
            for i, lo in ((i, int(texts.offsets[i]) + len(heads[i])) for i in range(2))
        ]
        assert seen[0] & seen[1]


def test_every_shared_window_is_covered(spark, sf_dir):
    """Against brute force over all windows of LEAST_BYTES bytes; what no such window holds is hardly reported."""
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, sf_dir, "documents").collect()}
    holders = collections.defaultdict(set)
    for d, t in texts.items():
        for i in range(len(t) - LEAST_BYTES + 1):
            holders[hash(t[i : i + LEAST_BYTES])].add(d)
    covered = {d: bytearray(len(t)) for d, t in texts.items()}
    for r in QUERIES["op5_substring_dedup"](spark, sf_dir).collect():
        covered[r["doc_id"]][r["start"] : r["start"] + r["length"]] = b"\1" * r["length"]
    shared = reported = 0
    for d, t in texts.items():
        want = bytearray(len(t))
        for i in range(len(t) - LEAST_BYTES + 1):
            if len(holders[hash(t[i : i + LEAST_BYTES])]) > 1:
                want[i : i + LEAST_BYTES] = b"\1" * LEAST_BYTES
        assert all(c for w, c in zip(want, covered[d]) if w)
        shared, reported = shared + sum(want), reported + sum(covered[d])
    assert 0 < shared <= reported <= 1.05 * shared


def test_every_planted_passage_is_found_to_its_ends(spark):
    """Passages of 51 words and periodic ones, some also in part in a document before."""
    rng = random.Random(11)
    docs, want = [], []
    for k in range(120):
        if k % 3 == 0:
            words = [rng.choice("abcdefghijkl") for _ in range(51)]
        elif k % 3 == 1:
            words = [f"w{k}", *["la", "li", "lu"] * 17][:51]
        else:
            words = [f"{rng.getrandbits(20):x}" for _ in range(51)]
        passage = " ".join(words)
        if k % 4 == 0:
            docs.append((k, f"<{k}> " + passage[10:85] + f" [{k}]"))
        for n in (1, 2):
            head, tail = prose(1000 * n + k, rng.randint(0, 40)) + f"{n}<", f">{n}" + prose(5000 * n + k, rng.randint(0, 40))
            docs.append((1000 * n + k, head + passage + tail))
            want.append((1000 * n + k, len((head).encode()), len((head + passage).encode())))
    covered = collections.defaultdict(set)
    texts = {d: t.encode() for d, t in docs}
    for r in repeated_spans(documents(spark, docs)).collect():
        part = texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] >= LEAST_BYTES and r["kept"] == (r["first_doc_id"] == r["doc_id"])
        if not r["kept"]:  # what a copy holds stands in the documents before, in overlapping pieces
            assert all(any(part[i : i + 64] in t for d, t in texts.items() if d < r["doc_id"]) for i in (0, r["length"] - 64))
        covered[r["doc_id"]] |= set(range(r["start"], r["start"] + r["length"]))
    for d, low, high in want:
        assert set(range(low, high)) <= covered[d]


def test_cuts_are_the_last_least_places_of_their_windows():
    rng = random.Random(5)
    for _ in range(60):
        sizes = [rng.choice([0, 1, 62, 63, 64, 65, 140]) for _ in range(rng.randint(1, 5))]
        texts = next(chunks(pa.array(["".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(n)) for n in sizes])))
        want = set()
        for lo, hi in zip(texts.offsets.tolist(), texts.offsets[1:].tolist()):
            rank = [sum(int(GEAR[texts.data[i - k]]) << k for k in range(min(i + 1, WINDOW))) % (1 << 32) for i in range(hi)]
            for first in range(lo + LEAD - 1, hi - REACH + 1):
                want.add(min(range(first, first + REACH), key=lambda i: (rank[i], -i)) + 1)
        assert cut_places(texts).tolist() == sorted(want)


def test_adjoining_chunks_inside_a_run_are_one_row():
    """Not over a gap, a change of row or of who holds them first, nor with those that begin or end a run."""
    names = ["row", "doc_id", "start", "long", "first_doc_id", "begins", "ends"]
    rows = [
        (1, 7, 0, 40, 3, True, False),
        (1, 7, 8, 50, 4, False, False),
        (1, 7, 26, 50, 2, False, False),
        (1, 7, 44, 50, 7, False, False),
        (1, 7, 62, 50, 7, False, False),
        (1, 7, 90, 50, 7, False, False),  # the chunk before it stands nowhere else
        (1, 7, 108, 50, 7, False, True),
        (2, 8, 126, 50, 5, False, False),
        (2, 8, 144, 50, 6, False, False),
    ]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    got = [tuple(r.values()) for part in _stretches([batch, batch.slice(0, 0)]) for r in part.to_pylist()]
    assert got == [
        (1, 7, 0, 40, 3, 1),
        (1, 7, 8, 76, 2, 2),
        (1, 7, 44, 112, 7, 2),
        (1, 7, 90, 140, 7, 1),
        (1, 7, 108, 158, 7, 1),
        (2, 8, 126, 194, 5, 2),
    ]


def test_no_window_reads_the_rest_of_its_group_for_every_row(spark, monkeypatch):
    """A frame from each row to the group's last takes the square of a group's rows."""
    plans = []

    def staged(frame, *args):
        plans.append(frame._jdf.queryExecution().toString())
        return stage(frame, *args)

    monkeypatch.setattr(chunking, "stage", staged)
    passage = prose(42, 60)
    got = repeated_spans(documents(spark, [(1, passage + prose(1, 30)), (2, prose(2, 30) + passage)])).collect()
    assert {r["doc_id"] for r in got} == {1, 2}
    assert any("currentrow$()" in p or "unboundedpreceding$()" in p for p in plans)
    assert not any("currentrow$(), unboundedfollowing$()" in p or "0, unboundedfollowing$()" in p for p in plans)
