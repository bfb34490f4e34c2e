"""Small tables with every odd case, and plain versions of what the operators share."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def word_list(text):
    return WORD.findall(lowered(text))


def shingles(text, width=5):
    w = word_list(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    made = random.Random(7)
    words = ["".join(made.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(made.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(words) for _ in range(n))


LONG = prose(1, 30000)
#: (doc_id, text): null, empty, blank, one word, no letter, very long, repeated rows, null id.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "Wort"),
    (5, "12 34 -- 56!"),
    (6, LONG),
    (7, prose(2, 60)),
    (7, prose(2, 60)),
    (8, prose(2, 60)),
    (None, prose(3, 40)),
    (9, "één \x00 nul und ＷＩＤＥ 😀 ende"),
    (10, "<|endoftext|> don't we'll x'd"),
]


def documents(spark, rows, **extra):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return frame.withColumns({k: F.lit(v) for k, v in extra.items()})


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}
