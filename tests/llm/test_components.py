import random

from fixtures import components as plain

from tallymill.llm.spread import components
from tallymill.sinks import shared_folder


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    names = list(range(200))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(60)]  # a chain in random order
    edges += [(names[80], names[i]) for i in range(81, 160)]  # a star
    edges += [(names[161], names[162]), (names[162], names[161]), (names[163], names[163])]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r["node"]: r["component"] for r in components(frame, shared_folder(spark)).collect()}
    want = plain(names, edges)
    assert set(got) == {n for e in edges for n in e if e[0] != e[1]}
    groups = {}
    for node, component in got.items():
        groups.setdefault(component, set()).add(want[node])
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == 3


def test_no_edges(spark):
    frame = spark.createDataFrame([], "a long, b long")
    assert components(frame, shared_folder(spark)).collect() == []
