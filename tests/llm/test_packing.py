import random
import zlib

import numpy as np
import pytest
from fixtures import ODD, documents, table
from tokenizers import Tokenizer

from tallymill.llm.packing import first_fit_decreasing, pack_documents, vocabulary_file
from tallymill.llm.queries import QUERIES


def plain_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check(rows, texts, size):
    tokenizer = Tokenizer.from_file(vocabulary_file())
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert sum(r["length"] for r in rows) == sum(len(plain_ids(tokenizer, t)) for _, t in texts)
    for doc, text in texts:
        ids = plain_ids(tokenizer, text)
        for r in by[doc]:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return sum(r["length"] for r in rows) / (size * len(sequences))


def test_odd_documents(spark):
    frame = documents(spark, ODD, offset=1, salt="x", packing_group=3)
    rows = pack_documents(frame, sequence=64, group_pieces=50).collect()
    check(rows, ODD, 64)
    assert pack_documents(documents(spark, []), sequence=64).collect() == []


def test_query(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert check(QUERIES["op9_packing"](spark, sf_dir).collect(), texts, 4096) > 0.98


def test_words_made_to_collide(spark):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    rows = pack_documents(documents(spark, texts).coalesce(1)).collect()
    check(rows, texts, 4096)


@pytest.mark.parametrize("seed", range(4))
def test_tree_packs_like_a_plain_search(seed):
    rng = random.Random(seed)
    items = sorted((rng.randint(1, 100) for _ in range(rng.randint(1, 200))), reverse=True)
    bins, offsets = first_fit_decreasing(np.array(items), 100)
    fill, want = [], []
    for x in items:
        k = next((i for i, f in enumerate(fill) if f + x <= 100), len(fill))
        if k == len(fill):
            fill.append(0)
        want.append((k, fill[k]))
        fill[k] += x
    assert list(zip(bins.tolist(), offsets.tolist())) == want
