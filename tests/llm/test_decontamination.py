import duckdb
from fixtures import LONG, ODD, documents, prose, shingles
from oracle import connect, differences

from tallymill.llm.decontamination import contaminated
from tallymill.llm.queries import ORACLES, QUERIES

ITEM = prose(11, 30)
HALF = " ".join(ITEM.split()[:18])
ITEMS = [(1, ITEM), (2, prose(12, 9)), (3, "too short"), (4, None), (5, prose(13, 400)), (None, ITEM), (6, "a b c d e")]


def test_odd_documents(spark):
    docs = [
        *ODD,
        (20, LONG[:5000] + " " + ", ".join(w[0].upper() + w[1:] if w[0].isascii() else w for w in ITEM.split()) + " " + LONG[5000:]),
        (21, HALF),
        (22, " ".join(ITEM.split()[1:])),
        (23, prose(13, 400) + "."),
        (24, "x A, b? C\nd e y"),
        (24, "a b c d e"),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS hashes")
    got = contaminated(documents(spark, docs, hashes=1, words="w"), items).collect()
    want = {}
    for d, text in docs:
        for i, item in ITEMS:
            s = {x for x in shingles(item) if len(x) == 5}
            if d is None or i is None or not s:
                continue
            found = len(s & shingles(text))
            if found >= 0.8 * len(s):
                want[d, i] = max(want.get((d, i), (0,)), (len(s), found))
    assert {(r["doc_id"], r["item_id"]): (r["item_shingles"], r["found_shingles"]) for r in got} == want
    assert {(20, 1), (22, 1), (23, 5), (24, 6)} <= set(want) and (21, 1) not in want
    assert contaminated(documents(spark, []), items).collect() == []
    assert contaminated(documents(spark, docs), items.limit(0)).collect() == []


def test_short_items(spark, tmp_path):
    docs = [*ODD, (20, "x, One two. THREE four y"), (21, "one  two three"), (22, "two three one"), (23, "four"), (None, "four"), (24, "a b c d e")]
    items = [(1, "one two three"), (2, "Four!"), (3, None), (4, "..."), (5, "a b c d e"), (6, "two three four y"), (7, ITEM), (None, "one"), (2, ITEM), (8, "xd")]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS run", "2 AS width")
    got = contaminated(documents(spark, docs, run=1, words="w"), frame, short_items=True).collect()
    assert sorted((r["doc_id"], r["item_id"], r["found_shingles"], r["containment"]) for r in got) == [
        (20, 1, 1, 1.0), (20, 2, 1, 1.0), (20, 6, 1, 1.0), (21, 1, 1, 1.0), (23, 2, 1, 1.0), (24, 5, 1, 1.0),
    ]
    only = contaminated(documents(spark, docs), frame).collect()
    assert [(r["doc_id"], r["item_id"]) for r in only] == [(24, 5)]
    for name, rows, key in zip(("documents", "benchmark"), (docs, [i for i in items if i[0] != 2 or i[1] != ITEM]), ("doc_id", "item_id")):
        rows = [r for r in rows if r[0] is not None and r[0] != 7]
        spark.createDataFrame(rows, f"{key} long, text string").coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert differences(QUERIES["op7_decontamination"](spark, str(tmp_path)), con, ORACLES["op7_decontamination"]) == ""


def test_query(spark, sf_dir):
    frame = QUERIES["op7_decontamination"](spark, sf_dir)
    assert differences(frame, connect(sf_dir), ORACLES["op7_decontamination"]) == ""
    assert not any(x in frame._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))
