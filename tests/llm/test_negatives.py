import math

import numpy as np
import pytest
from oracle import connect, differences

from tallymill.llm import negatives as N
from tallymill.llm.queries import ORACLES, QUERIES


def plain(rows, every=100):
    """All pairs in Python integers."""
    part = []
    for vec_id, e, label in rows:
        if vec_id is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(256 * x) for x in e]
        if all(abs(x) < 1 << 30 for x in v) and sum(x * x for x in v) < 1 << 60:
            part.append((vec_id, v, label))
    out = []
    for i, (a, q, label) in enumerate(part):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), b, other) for j, (b, v, other) in enumerate(part) if j != i]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [str((a, positive, rank + 1, b, -p, -s)) for rank, (s, b, _) in enumerate(fits)]
    return sorted(out)


def shown(frame):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(str(tuple(r[n] for n in names)) for r in frame.collect())


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.selectExpr("*", "1 AS node", "'x' AS row", "2 AS block", "3 AS square").repartition(3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [2.0, 0.0], 1), (3, [0.9, 0.5], 2), (4, [0.9, 0.5], 3), (5, [1.9, 0.1], 2),
        (100, [0.0, 0.0], 1), (200, [-1.0, 0.0], 1), (300, [], 2), (400, [1.0], 2), (500, [1.0, 0.2, 3.0], 2), (6, None, 1),
        (7, [None, 1.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, 1.0], None), (None, [1.0, 1.0], 2),
        (600, [1.0, 0.5], 1), (600, [1.0, 0.5], 1), (600, [1.0, 0.5], 2), (11, [1e200, 0.0], 2), (12, [4e6, 1e6], 2), (700, [4e6, 0.0], 1),
        (13, [4e6, 3.0], 1), (800, None, None), (-100, [0.3, 0.1], 2), (14, [5e6, 0.0], 1),
    ]
    assert shown(N.hard_negatives(vectors(spark, rows))) == plain(rows)
    assert N.hard_negatives(vectors(spark, [])).collect() == []
    assert N.hard_negatives(vectors(spark, [(1, None, 1)])).collect() == []
    assert N.hard_negatives(vectors(spark, [(100, [0.0], 1), (2, [0.0], 1), (3, [0.0], 2)])).count() == 1


def clusters(seed, n, dim):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    size = rng.choice([0.2, 1, 3], n)
    points = (centres[rng.integers(9, size=n)] + rng.normal(size=(n, dim)) * rng.choice([0, 0.1, 0.5], (n, 1))) * size[:, None]
    points[: n // 3] = points[0]  # one very common vector
    return [(i, p.tolist(), int(rng.integers(3))) for i, p in enumerate(points)]


@pytest.mark.parametrize("settings", [{}, {"block": 40, "anchors": 7, "centres": 12}, {"sample": 3, "block": 100}])
def test_clusters_against_all_pairs(spark, settings):
    rows = clusters(3, 700, 8)
    assert shown(N.hard_negatives(vectors(spark, rows), every=9, **settings)) == plain(rows, 9)


def test_bounds_hold_and_skip():
    """No vector scores outside the bounds of a node that holds it, and clustered vectors leave most leaves unread."""
    rng = np.random.default_rng(1)
    spread = rng.normal(size=(20, 16)) * 300
    vectors = np.floor(spread[rng.integers(20, size=2000)] + rng.normal(size=(2000, 16)) * 10).astype(np.int64)
    squares = (vectors**2).sum(axis=1)
    most = int(squares.max())
    points = N.on_sphere(vectors, squares, most)
    tree = N.Tree.over(points)
    leaves = [leaf for leaf in tree.leaves if leaf is not None]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(2000))
    asked = vectors[:20]
    norms = np.sqrt((asked**2).sum(axis=1).astype(float))
    low, high = N.bounds((asked / norms[:, None]) @ points[tree.centres, :-1].T, tree.radii, norms[:, None] * np.sqrt(float(most)))
    scores = asked @ vectors.T

    def under(node):
        leaf = tree.leaves[node]
        return leaf if leaf is not None else np.concatenate([under(c) for c in tree.children[node]])

    for node in range(low.shape[1]):
        mine = scores[:, under(node)]
        assert (low[:, node] <= mine.min(axis=1)).all() and (mine.max(axis=1) <= high[:, node]).all()
    tops = np.quantile(scores, 0.97, axis=1).astype(np.int64)
    windows = np.array([(N.LOW, N.HIGH, N.LOW) if i % 2 else (t // 2, t, N.LOW) for i, t in enumerate(tops)])
    counts = np.arange(2000)[None] % 20 != np.arange(20)[:, None]
    who, other, score, read = N.descend(tree, vectors, asked, counts, windows, low, high, 5)
    for i, (lo, hi, _) in enumerate(windows):
        want = sorted((-int(s), j) for j, s in enumerate(scores[i]) if lo <= s <= hi and counts[i, j])[:5]
        assert [(-int(s), int(j)) for s, j in zip(score[who == i], other[who == i])] == want
    assert read < 20 * 2000 / 3


def test_query(spark, sf_dir):
    frame = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert differences(frame, connect(sf_dir), ORACLES["op11_hard_negatives"]) == ""
