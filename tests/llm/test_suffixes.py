import hashlib
import random

import numpy as np
import pytest
from fixtures import ODD, documents, prose, table

from tallymill.llm import suffixes as S
from tallymill.llm.queries import QUERIES


def plain(rows, length=200):
    """Every window of every text in one dictionary."""
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for x in texts:
        for i in range(len(x) - length + 1):
            w = x[i : i + length]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for (doc, _), x in zip(rows, texts):
        go = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                go[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(x, go) if not g)
        spans = sum(g and not (i and go[i - 1]) for i, g in enumerate(go))
        out.append(str((doc, len(x), sum(go), spans, hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def shown(frame):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(str(tuple(r[n] for n in names)) for r in frame.collect())


@pytest.mark.parametrize("letters", [1, 2, 4, 30])
def test_suffixes_stand_in_order(letters):
    rng = np.random.default_rng(letters)
    for n in [*range(0, 40), 301, 302, 303]:
        t = rng.integers(1, letters + 1, n)
        want = sorted(range(n), key=lambda i: t[i:].tolist())
        assert S.suffix_order(t, 10**6).tolist() == want
        for need in (1, 4, 10):
            cut = [t[i : i + need].tolist() for i in S.suffix_order(t, need)]
            assert cut == sorted(cut)


def test_repeated_windows():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))).encode() for _ in range(40)]
    for length in (8, 9, 13):
        seen = {}
        for x in texts:
            for i in range(len(x) - length + 1):
                seen.setdefault(x[i : i + length], []).append(i)
        for x, found in zip(texts, S.repeated_windows(texts, length)):
            assert found.tolist() == [len(seen[x[i : i + length]]) > 1 for i in range(len(x) - length + 1)]


def repeats():
    """Passages in other surroundings, a text that repeats itself, periodic texts, copies, multi-byte edges."""
    rng = random.Random(8)
    passage, second = prose(50, 60), prose(51, 38)
    rows = [(i, prose(100 + i, 20) + " " + passage[rng.randrange(90) :][: rng.randrange(150, 400)] + prose(200 + i, 20)) for i in range(40)]
    rows += [(50 + i, "é" * i + second + prose(300 + i, 30) + second) for i in range(5)]
    rows += [(60, "a" * 900), (61, "a" * 199), (62, "a" * 200 + "b" + "a" * 199), (63, "ab" * 300), (64, "ba" * 99 + "xy")]
    rows += [(70, prose(400, 80)), (70, prose(400, 80)), (None, prose(400, 80)[3:]), (71, None), (72, ""), (73, "x" * 200), (74, "y" * 201)]
    return rows


@pytest.mark.parametrize("bucket, piece", [(4096, 1 << 20), (2, 1 << 20), (5, 333)])
def test_against_all_windows(spark, monkeypatch, bucket, piece):
    """With small buckets every bucket is hot and halved down to single windows; with small pieces stretches are cut."""
    monkeypatch.setattr(S, "PIECE", piece)
    rows = repeats() + ODD
    frame = documents(spark, rows, row="x", bucket=1, n=2, kept="k").repartition(3)
    got = S.without_repeats(frame, bucket=bucket).selectExpr(
        "doc_id", "octet_length(kept) + aggregate(spans, 0L, (n, s) -> n + s.stop - s.start) AS n_bytes",
        "aggregate(spans, 0L, (n, s) -> n + s.stop - s.start) AS n_removed", "size(spans) AS n_spans", "sha2(kept, 256) AS kept_sha256",
    )
    assert shown(got) == plain(rows)


def test_other_lengths(spark):
    rows = [(i, t) for i, (_, t) in enumerate(repeats())]
    got = S.without_repeats(documents(spark, rows), length=65, gram=16).collect()
    want = {eval(w)[0]: eval(w)[1:4] for w in plain(rows, 65)}
    for r in got:
        gone = sum(s["stop"] - s["start"] for s in r["spans"])
        assert (len(r["kept"]) + gone, gone, len(r["spans"])) == want[r["doc_id"]]
    with pytest.raises(ValueError):
        S.without_repeats(documents(spark, rows), gram=24)


def test_empty_table(spark):
    frame = S.suffix_dedup(documents(spark, []))
    assert frame.collect() == [] and set(frame.columns) == {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert shown(QUERIES["op13_suffix_dedup"](spark, sf_dir)) == plain(rows)
