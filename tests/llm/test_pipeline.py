import collections
import zlib

import numpy as np
from fixtures import ODD, components, documents, prose, shingles, table
from test_secrets import base
from tokenizers import Tokenizer

import corpus_pipeline as P
from tallymill.llm.packing import vocabulary_file
from tallymill.llm.secrets import linked_spans, redacted, weak_spans


def plain(rows, items):
    """The documents that reach packing, by brute force."""
    rows = [(d, t) for d, t in rows if any(map(str.isalpha, t or ""))]
    sets = {d: shingles(t) for d, t in rows}
    by = collections.defaultdict(set)
    for d, s in sets.items():
        for x in s:
            by[x].add(d)
    met = collections.Counter((a, b) for ds in by.values() for a in ds for b in ds if a < b)
    links = [k for k, n in met.items() if n >= 0.8 * (len(sets[k[0]]) + len(sets[k[1]]) - n) - 1e-9]
    of = components(sets, links)
    rows = [(d, t) for d, t in rows if of[d] == d]
    tests = [s for s in ({x for x in shingles(i) if len(x) == 5} for i in items) if s]
    rows = [(d, t) for d, t in rows if not any(len(s & sets[d]) >= 0.8 * len(s) for s in tests)]
    out = {}
    for d, t in rows:
        strong = base(t)
        out[d] = redacted(t, [*strong, *linked_spans(t, strong, weak_spans(t))])
    return out


def test_run_is_the_plain_pipeline(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    want = plain(rows, [r["text"] for r in table(spark, sf_dir, "benchmark").collect()])
    tokenizer = Tokenizer.from_file(vocabulary_file())
    got = collections.defaultdict(dict)
    for r in P.run(spark, sf_dir).collect():
        got[r["doc_id"]][r["start"]] = r
    assert set(got) == set(want)
    for d, text in want.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert sum(r["length"] for r in got[d].values()) == len(ids)
        for start, r in got[d].items():
            assert r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())


def test_stages_keep_the_columns_and_take_odd_documents(spark, sf_dir, tmp_path):
    secret = "token=" + "0123456789abcdef" * 2
    rows = [*ODD, (30, prose(50, 40) + " " + secret), (31, prose(51, 40))]
    docs = documents(spark, rows, lang_pred="a", score=1, clean="c", key=5, words="w")
    columns = docs.columns
    for k, (name, apply) in enumerate(P.STAGES[:-1]):
        path = str(tmp_path / name)
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        empty = apply(spark, docs.limit(0), sf_dir)
        assert empty.columns == columns and empty.count() == 0
    kept = {r["doc_id"]: r for r in docs.collect()}
    assert {4, 6, 7, 9, 10, 30, 31, None} == set(kept)
    assert secret not in kept[30]["text"] and kept[30]["n_chars"] == len(kept[30]["text"])
    assert kept[31]["text"] == prose(51, 40) and kept[31]["lang_pred"] == "a" and kept[31]["clean"] == "c"
    assert P.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0
    assert {r["doc_id"] for r in P.STAGES[-1][1](spark, docs, sf_dir).collect()} == set(kept)


def test_one_row_of_each_class_stays(spark, sf_dir):
    """Rows that share an id or have none are rows of their own."""
    text = prose(60, 80)
    rows = [(1, text), (1, text), (1, text), (None, text + " more"), (None, prose(61, 80)), (None, prose(61, 80)), (2, None), (2, None), (3, text)]
    docs = documents(spark, rows, _row="x")
    kept = P.drop_near_duplicates(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    want = [(1, text), (None, prose(61, 80)), (2, None), (2, None)]
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(map(str, want))


def test_contaminated_rows_without_an_id_go(spark, sf_dir):
    item = next(r["text"] for r in table(spark, sf_dir, "benchmark").orderBy("item_id").collect() if len(shingles(r["text"])) > 5)
    rows = [(None, prose(70, 30) + " " + item + " " + prose(71, 30)), (None, prose(72, 60)), (5, prose(73, 60)), (5, item), (6, None)]
    kept = P.decontaminate(spark, documents(spark, rows), sf_dir).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in kept) == sorted(str(rows[i]) for i in (1, 2, 4))


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]


def test_without_labels_only_texts_without_a_letter_go(spark, sf_dir):
    docs = documents(spark, ODD).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    kept = P.identify_language(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    want = sorted(str(d) for d, t in ODD if any(map(str.isalpha, t or "")))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
