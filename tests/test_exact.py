"""Quantiles, largest groups, checksums and quarantine against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tallymill.operators.checks import compare_contents, content_checksum, dimension_check
from tallymill.operators.heavy import largest_groups
from tallymill.operators.quantiles import exact_quantiles
from tallymill.sources.quarantine import read_quarantined

NAN = float("nan")


def numbers(kind, n, seed=1):
    rng = random.Random(seed)
    draw = {
        "few": lambda: rng.randrange(5),
        "many": lambda: rng.gauss(0, 1000),
        "skewed": lambda: 7.0 if rng.random() < 0.6 else rng.expovariate(0.001),
        "odd": lambda: rng.choice([None, NAN, float("inf"), -0.0, 0.0, rng.random()]),
    }[kind]
    return [(rng.choice(["a", "b", None]), None if (v := draw()) is None else float(v)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["few", "many", "skewed", "odd"])
@pytest.mark.parametrize("few, cells", [(10, 8), (10_000, 64)])
def test_quantiles(spark, tmp_path, kind, few, cells):
    frame = spark.createDataFrame([*numbers(kind, 3000), ("one", 5.0), ("none", None)], "k string, v double")
    shares = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = exact_quantiles(frame, ["k"], "v", shares, str(tmp_path), few=few, cells=cells)
    clean = frame.where("v IS NOT NULL AND NOT isnan(v)")
    want = clean.groupBy("k").agg(F.count("*").alias("n"), F.percentile("v", F.array(*[F.lit(s) for s in shares])).alias("q")).collect()
    expected = {(r["k"], s): (r["n"], pytest.approx(q, rel=1e-12)) for r in want for s, q in zip(shares, r["q"])}
    assert {(r["k"], r["share"]): (r["row_count"], r["quantile"]) for r in got.collect()} == expected


def test_quantiles_shuffle_does_not_grow(spark, tmp_path):
    """Bytes of the tables between passes depend on groups alone, and passes on the logarithm of the rows."""
    for n in (2000, 64000):
        frame = spark.range(n).select((F.col("id") % 2).alias("k"), F.hash("id").cast("double").alias("v"))
        exact_quantiles(frame, ["k"], "v", [0.5], str(tmp_path / str(n)), few=50, cells=16).collect()
    small, large = (sorted(p.name for p in (tmp_path / str(n)).glob("targets_*")) for n in (2000, 64000))
    assert len(small) <= len(large) <= len(small) + 3
    assert spark.read.parquet(str(tmp_path / "64000" / large[-1])).count() <= 4


@pytest.mark.parametrize("heavy", [0, 3, 40])
def test_largest_groups(spark, tmp_path, heavy):
    """No heavy values at all, some, and more than are asked for; null and empty texts count; ties go by value."""
    rng = random.Random(heavy)
    values = [f"v{i}" for i in range(3000)] + [None] * 4 + [""] * 4 + ["=", "null"] * 4
    for i in range(heavy):
        values += [f"h{i}"] * rng.choice([20, 50, 50, 70])
    rng.shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "k string")
    for k in (1, 5, 20):
        got = largest_groups(frame, "k", k, str(tmp_path / str(k)), buckets=64, candidates=64).collect()
        counts = {}
        for v in values:
            counts[v] = counts.get(v, 0) + 1
        want = sorted(counts.items(), key=lambda c: (-c[1], c[0] is not None, c[0] or ""))[:k]
        assert [tuple(r) for r in got] == want
    few = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in largest_groups(few, "k", 9, str(tmp_path / "few")).collect()] == [("a", 2), (None, 1)]
    assert largest_groups(few.limit(0), "k", 9, str(tmp_path / "none")).collect() == []


def test_proven_buckets_are_not_counted_by_value(spark, tmp_path):
    rows = spark.range(200000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 20).otherwise(F.col("id")).alias("k"))
    got = largest_groups(rows, "k", 5, str(tmp_path), buckets=4096)
    assert [tuple(r) for r in got.collect()] == [(str(k), 10000) for k in (0, 10, 12, 14, 16)]
    assert spark.read.parquet(str(tmp_path / "unproven")).count() == 0
    assert spark.read.parquet(str(tmp_path / "counted")).count() < 6000


def test_checksum_of_contents(spark):
    rows = [(1, "a", None, 1.5), (2, None, "b", -0.0), (2, None, "b", -0.0), (3, "", "c", NAN)]
    schema = "id int, x string, y string, z double"
    frame = spark.createDataFrame(rows, schema)
    status = lambda other: [r["Status"] for r in compare_contents(frame, other, frame.columns).collect()]
    same = spark.createDataFrame(rows[::-1], schema).select("z", "y", "x", "id").repartition(3)
    assert status(same) == ["PASS"] * 3
    changed = [
        [(1, None, "a", 1.5), *rows[1:]],  # a cell in the next column
        [(1, "a", "", 1.5), *rows[1:]],  # empty instead of null
        [(1, "a", None, 1.25), *rows[1:]],
        [rows[0], rows[0], rows[0], rows[3]],  # the same count, other rows twice
    ]
    for other in changed:
        got = status(spark.createDataFrame(other, schema))
        assert got[0] == "PASS" and got[1] == "FAIL"
    assert status(frame.limit(0)) == ["FAIL", "FAIL", "FAIL"]
    assert content_checksum(frame.limit(0)).first() == (0, 0, 0)


def test_dimension_check_can_fail(spark):
    counts = spark.createDataFrame([("State", "x", 3), ("Year", "1", 2)], "Dimension string, Value string, Accident_Count long")
    got = dimension_check(counts, spark.createDataFrame([(3,)], "n long"), ["State", "Year", "Severity"]).collect()
    assert [(r["Dimension"], r["Total"], r["Status"]) for r in got] == [("State", 3, "PASS"), ("Year", 2, "FAIL"), ("Severity", 0, "FAIL")]


def test_quarantine(spark, tmp_path):
    lines = [
        "n,x,flag,text",
        '1,2.5,true,"a, ""b"""',
        "2,,,",
        "three,1,true,c",
        "4,1,perhaps,",
        "five,six,no,d",
        "6,1.5",
        "7,1,false,e,f",
        "eight,1,false,g,h",
        ",,,",
    ]
    path = tmp_path / "in.csv"
    path.write_text("\n".join(lines) + "\n")
    got = read_quarantined(spark, str(path), str(tmp_path / "q"), schema="`n` INT, `x` DOUBLE, `flag` BOOLEAN, `text` STRING", escape='"')
    assert [tuple(r) for r in got.good.orderBy(F.asc_nulls_last("n")).collect()] == [(1, 2.5, True, 'a, "b"'), (2, None, None, None), (None, None, None, None)]
    bad = {r["record"]: (r["bad_columns"], r["wrong_length"]) for r in got.bad.collect()}
    assert bad == {
        "three,1,true,c": (["n"], False),
        "4,1,perhaps,": (["flag"], False),
        "five,six,no,d": (["n", "x", "flag"], False),
        "6,1.5": ([], True),
        "7,1,false,e,f": ([], True),
        "eight,1,false,g,h": (["n"], True),
    }
    assert {r["column"]: r["bad_records"] for r in got.columns.collect()} == {"n": 3, "x": 1, "flag": 2, None: 3}
    clean = read_quarantined(spark, str(path), str(tmp_path / "all"), schema="`a` STRING, `b` STRING, `c` STRING, `d` STRING", escape='"')
    assert clean.good.count() == 6 and clean.columns.collect()[0]["bad_records"] == 3
