import random

import numpy as np
import pyarrow as pa
import pytest
from fixtures import ODD, components, documents, prose, shingles, table

from tallymill.llm.jaccard import PATH_NAMES, _candidates, chosen_paths, digest, jaccard_classes, leaves, recall, sketch
from tallymill.llm.queries import QUERIES
from tallymill.sinks import shared_folder


def plain(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9
    ]
    n = [sum(i in link for link in links) for i in range(len(rows))]
    of = components(range(len(rows)), links)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[of[i]] = min(d, least.get(of[i], d))
    return sorted(str((d, n[i], least.get(of[i]))) for i, (d, _) in enumerate(rows))


def shown(frame):
    return sorted(str((r["doc_id"], r["n_links"], r["class_id"])) for r in frame.collect())


def test_odd_documents(spark):
    frame = documents(spark, ODD, key=1, size=2, n_links="x")
    got = jaccard_classes(frame)
    assert shown(got) == plain(ODD)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got.collect())
    assert jaccard_classes(documents(spark, [])).collect() == []


def edited(text, rng, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = "edit" + str(rng.random())[2:8]
    return " ".join(words)


@pytest.mark.parametrize("small, block", [(256, 256), (4, 6)])
def test_groups_that_share_a_passage(spark, small, block):
    """Chains of edits, a group of near copies, and texts alike in one passage alone."""
    rng = random.Random(1)
    passage = prose(99, 80)
    rows = []
    for g in range(6):
        text = prose(200 + g, 150)
        for _ in range(8):
            rows.append((len(rows) * 3 % 101, text))
            text = edited(text, rng, 2)
    base = prose(300, 200)
    rows += [(200 + i, edited(base, rng, rng.randint(1, 6))) for i in range(30)]
    rows += [(300 + i, prose(400 + i, 60) + " " + passage) for i in range(30)]
    assert shown(jaccard_classes(documents(spark, rows).repartition(3), small=small, block=block)) == plain(rows)


def test_recall_is_set_by_the_runs():
    assert recall(runs=1, depth=1) > 0.6 and recall(depth=1) > 0.9999 and recall() > 0.9998


def meets(a, b, depth):
    """Whether two sets share a path of ``depth`` choices."""
    paths = [chosen_paths(x, 10, 0.8)[depth - 1][0] for x in (a, b)]
    return bool(np.intersect1d(*paths).size)


def test_recall_measured_at_each_depth():
    rng = np.random.default_rng(5)
    lost = [0, 0]
    for _ in range(2000):
        both = rng.integers(0, 2**64, 80, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**64, 10, dtype=np.uint64)])) for _ in range(2))
        for d in (1, 2):
            lost[d - 1] += not meets(a, b, d)
    assert lost[0] <= 4 and lost[1] <= 6


@pytest.mark.parametrize("many", [200, 800])
def test_short_texts_alike_in_one_shingle_are_no_candidates(many):
    """The number of candidates does not grow with a bucket of unrelated short texts."""
    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**64, 1, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(0, 2**64, 11, dtype=np.uint64)])) for _ in range(many)]
    sets.append(np.unique(np.concatenate([sets[0][:-1], rng.integers(0, 2**64, 1, dtype=np.uint64)])))
    batch = pa.RecordBatch.from_pydict(
        {
            "path": [1] * len(sets), "left": [0] * len(sets), "right": [0] * len(sets), "own": [0] * len(sets),
            "key": [digest(x) for x in sets], "size": [len(x) for x in sets],
            "sketch": [sketch(x).tobytes() for x in sets], "few": [x.view(np.int64).tolist() for x in sets],
        }
    )
    edges = [e for out in _candidates([batch], 0.8) for e in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    assert {frozenset(e) for e in edges} == {frozenset((digest(sets[0]), digest(sets[-1])))}


def test_a_set_in_large_buckets_is_found_once_and_chooses_again(spark):
    """One row per set goes through the joins, however many large buckets and choices it has."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**63, 20, dtype=np.uint64)
    near = [np.unique(np.append(common, rng.integers(0, 2**63, 1, dtype=np.uint64))) for _ in range(9)]
    sets = near + [np.unique(rng.integers(0, 2**63, 20, dtype=np.uint64)) for _ in range(5)]
    rows, buckets = [], [{}, {}]
    for own in sets:
        levels = chosen_paths(own, 10, 0.8)
        rows.append([digest(own), *[x.view(np.int64).tolist() if i == 0 else x.tolist() for level in levels for i, x in enumerate(level)]])
        for d in range(2):
            for path in rows[-1][1 + 2 * d]:
                buckets[d].setdefault(path, set()).add(digest(own))
    large = {p for p, k in buckets[0].items() if len(k) > 4}
    assert large
    want = {(k, p) for p, keys in buckets[0].items() if 1 < len(keys) <= 4 for k in keys}
    below = {(r[0], p) for r in rows for p, i in zip(r[3], r[4]) if r[1][i] in large}
    times = {p: sum(q == p for _, q in below) for _, p in below}
    want |= {(k, p) for k, p in below if times[p] > 1}
    kinds = ", ".join(f"{n} array<{'long' if n.startswith('path') else 'int'}>" for n in PATH_NAMES)
    frame = spark.createDataFrame([tuple(r) for r in rows], f"key binary, {kinds}")
    folder = shared_folder(spark)
    found = leaves(frame, folder, 4).collect()
    got = [(bytes(r["key"]), r["path"]) for r in found]
    assert set(got) == want and len(got) == len(want)
    assert all(r["n"] == sum(p == r["path"] for _, p in got) for r in found)
    assert spark.read.parquet(f"{folder}/chosen_2").count() == len({k for p in large for k in buckets[0][p]})


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert shown(QUERIES["op2_jaccard_join"](spark, sf_dir)) == plain(rows)
