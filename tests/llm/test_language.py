import random
import zlib

import pytest
from fixtures import ODD, documents, prose, table
from pyspark.sql import functions as F

from tallymill.llm.language import SAMPLE_CHARS, STRIP, identify, labelled_sample, phrases, predict, train
from tallymill.llm.queries import QUERIES


def greedy(sample, text):
    """Phrases of the longest-match parse; a letter the sample lacks is a phrase of its own."""
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size
        n += 1
    return n


@pytest.mark.parametrize("seed", range(6))
def test_phrases_are_those_of_a_plain_parse(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    samples = {"x": make(300), "y": make(40)}
    texts = [make(rng.randint(1, STRIP)) for _ in range(20)] + [""]
    counts, sizes = phrases(train(samples), texts)
    assert sizes.tolist() == [len(t) for t in texts]
    for t, row in zip(texts, counts.tolist()):
        assert row == [greedy(samples["x"], t), greedy(samples["y"], t)]


def test_case_and_marks_do_not_matter_and_length_is_whole():
    model = train({"a": "alpha beta gamma", "b": "один два три"})
    names, score = predict(model, ["ALPHA, beta!!", "Один-два", "1 2", None, "", "alpha " * 5000 + "один два три " * 9000])
    assert names == ["a", "b", "und", "und", "und", "b"]
    assert all(0 <= s <= 1 for s in score) and score[2:5].tolist() == [0, 0, 0]


def test_odd_documents(spark):
    frame = documents(spark, ODD, lang_pred="zz", score=3)
    got = identify(frame, frame.select("text", "lang"))
    assert got.count() == len(ODD) and got.columns[-2:] == ["lang_pred", "score"]
    by = {r["doc_id"]: r for r in got.collect()}
    assert [by[k]["lang_pred"] for k in (1, 2, 3, 5)] == ["und"] * 4 and by[4]["lang_pred"] == "en"
    none = identify(frame, frame.select("text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    empty = documents(spark, [])
    assert identify(empty, empty.select("text", "lang")).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    rows = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op10_language_id"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == rows[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_languages_are_told_apart_by_letters_beyond_the_most_frequent():
    """Two scripts of 60 letters, and two languages each of further scripts, one beyond the first plane."""
    line = lambda first, n, step=1: " ".join(chr(first + (i * step) % n) * 2 for i in range(3 * n))
    samples = {
        "a1": line(0x4E00, 60) * 3, "a2": line(0x5E00, 60) * 3, "b1": line(0x3B1, 17), "b2": line(0x430, 32),
        "c1": line(0xAC00, 50, 7), "c2": line(0xAD00, 50, 7), "d1": line(0x20000, 40), "d2": line(0x20100, 40),
    }
    assert len(set("".join(samples.values()))) > 300
    names, score = predict(train(samples), [v[:60] for v in samples.values()] + ["\u1200\u1201 a"])
    assert names[:-1] == list(samples) and (score[:-1] > 0).all() and score[-1] == 0


def test_letters_without_a_column_parse_alike():
    rng = random.Random(5)
    make = lambda n: "".join(chr(0x4E00 + min(rng.randrange(200), rng.randrange(200))) for _ in range(n))
    letters = "".join(chr(0x4E00 + i) for i in range(200))
    samples = {"x": make(3000) + letters, "y": letters[::-1] + make(900)}
    texts = [make(40) + samples["x"][100:130] + make(5) + samples["y"][50:90] for _ in range(20)]
    counts, _ = phrases(train(samples), texts)
    assert counts.tolist() == [[greedy(samples["x"], t), greedy(samples["y"], t)] for t in texts]


def test_every_language_has_a_sample(spark):
    """One text on all rows of a language, one beside many repeats of another, more texts than are drawn, many languages."""
    same = [("one", "unus textus") for _ in range(3000)]
    some = [("two", prose(1, 40))] * 2000 + [("two", prose(2, 40))]
    many = [("many", prose(k, 30)) for k in range(3000)]
    others = [(f"l{k}", prose(10_000 + k, 3000)) for k in range(30)]
    frame = spark.createDataFrame([*same, *some, *many, *others, (None, "x y"), ("none", ""), ("none", None)], "lang string, text string")
    got = labelled_sample(frame.repartition(5))
    assert set(got) == {"one", "two", "many", *[k for k, _ in others]}
    assert got["one"] == "unus textus" and sorted(got["two"].split("\n")) == sorted([prose(1, 40), prose(2, 40)])
    share = SAMPLE_CHARS // len(got)
    assert len(got["many"]) == share and all(got[k] == t[: share // 16] for k, t in others)
    assert labelled_sample(frame.limit(0)) == {}
