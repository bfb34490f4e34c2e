import numpy as np
from fixtures import components, table

from tallymill.llm import neighbours as N
from tallymill.llm.queries import QUERIES


def plain(rows):
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, float) if ok else None
        unit.append(u / np.abs(u).max() / np.linalg.norm(u / np.abs(u).max()) if ok else None)
    links = []
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.98:
                links.append((i, j))
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    of = components(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[of[i]] = min(r[0], least.get(of[i], r[0]))
    return sorted(str((r[0], n[i], least.get(of[i]))) for i, r in enumerate(rows))


def shown(frame):
    return sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in frame.collect())


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.selectExpr("*", "1 AS key", "'x' AS unit", "2 AS list")


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.05], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1),
        (12, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.01, 0.0], 1), (14, [1.0, 0.0], 1), (14, [1.0, 0.0], 1), (None, [0.0, 1.0], 1),
        (15, [1e-200, 0.0], 1), (16, [1e200, 1e198], 1), (17, [-1.0, 0.0], 1), (18, [1.0, 0.35], 1),
    ]
    got = N.near_vectors(vectors(spark, rows))
    assert shown(got) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.collect())
    assert N.near_vectors(vectors(spark, [])).collect() == []
    assert shown(N.near_vectors(vectors(spark, [(1, None, 1)]))) == ["(1, 0, 1)"]


def test_clusters_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "QUERIES", 24)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    rows = []
    for i in range(600):
        v = centres[i % 12] + rng.normal(size=24) * rng.choice([0, 0.05, 0.12, 0.2])
        rows.append((i, v.tolist(), int(rng.integers(3))))
    want = plain(rows)
    assert sum(int(w.split(", ")[1]) for w in want) > 2000
    assert shown(N.near_vectors(vectors(spark, rows), sample=200, list_size=30)) == want


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, sf_dir, "embeddings").collect()]
    assert shown(QUERIES["op1_near_vectors"](spark, sf_dir)) == plain(rows)
