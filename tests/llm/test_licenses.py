import math
import random

from fixtures import ODD, documents, table, word_list

from tallymill.llm.licenses import PHRASES, TEMPLATES, license_scan
from tallymill.llm.queries import QUERIES

MIT = TEMPLATES[1][1]
TEXTS = [
    "x " * 37 + "Released under the MIT License. CC BY-NC 4.0; cc by nc",
    "y " * 100 + MIT.upper() + " z" * 50,
    " ".join(w for i, w in enumerate(MIT.split()) if i % 6) + " end",
    " ".join(w for i, w in enumerate(MIT.split()) if i % 3),
    "apache\nlicense, version 2 apache license version 2.0 licensed under the",
    "the " * 500,
]


def plain(text):
    words = word_list(text)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    labels, score = set(base), 1.0 if base else 0.0
    for label, template in TEMPLATES:
        t = template.split()
        need = math.ceil(len(set(t)) * 0.8 - 1e-9)
        for start in (i for i in range(len(words)) if words[i] in t):
            common = len(set(t) & set(words[start : start + 2 * len(t)]))
            if common >= need:
                labels.add(label)
                score = max(score, common / len(set(t)))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 12),
    )


def rows_of(frame):
    return sorted(map(str, ((*r[:7], round(r[7], 12)) for r in map(tuple, ((x["doc_id"], x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"], x["labels"], x["score"]) for x in frame.collect())))))


def test_odd_documents(spark):
    rows = [*ODD, *[(100 + i, t) for i, t in enumerate(TEXTS)]]
    want = sorted(str((d, *plain(t))) for d, t in rows)
    assert rows_of(license_scan(documents(spark, rows, labels=1, score="x"))) == want
    assert license_scan(documents(spark, [])).collect() == []


def test_a_match_does_not_hang_on_where_it_begins(spark):
    words = [f"t{i}" for i in range(20)]
    rng, rows = random.Random(4), []
    for stretch in (22, 26, 30, 36, 40):
        for offset in range(20):
            inner = sorted(rng.sample(range(1, stretch - 1), 14))
            held = dict(zip([0, *inner, stretch - 1], rng.sample(words, 16)))
            rows.append((len(rows), " ".join(["x"] * offset + [held.get(i, "y") for i in range(stretch)] + ["z"] * 50)))
    rows.append((len(rows), " ".join(["x"] * 9 + words[:8] + ["y"] * 25 + words[8:16])))  # 41 words
    got = license_scan(documents(spark, rows), templates=(("own", " ".join(words)),)).collect()
    assert {r["doc_id"] for r in got if r["labels"] == "own" and r["score"] == 0.8} == set(range(len(rows) - 1))


def test_query(spark, sf_dir):
    want = sorted(str((r["doc_id"], *plain(r["text"]))) for r in table(spark, sf_dir, "documents").collect())
    assert rows_of(QUERIES["op4_license_scan"](spark, sf_dir)) == want
