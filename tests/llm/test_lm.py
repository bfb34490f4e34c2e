import collections
import functools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fixtures import ODD, documents, lowered, prose, table

from tallymill.llm import lm
from tallymill.llm.lm import BOUNDARY, DEPTH, SHALLOW, byte_classes, lgamma, score_documents
from tallymill.llm.queries import QUERIES
from tallymill.llm.text import chunks


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), None]


def check_base(got, texts, training):
    counts = collections.Counter(t for text in training for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        own = tokens(texts[r["doc_id"]])
        assert r["n_tokens"] == len(own) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[t] > 0 for t in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own))


def kt(a, b):
    out, zeros, ones = 0.0, 0, 0
    for bit in [0] * a + [1] * b:
        out += math.log(((ones if bit else zeros) + 0.5) / (zeros + ones + 1))
        zeros, ones = zeros + (bit == 0), ones + (bit == 1)
    return out


def node_of(line, i, d, classes):
    """A context of d bytes: classes down to SHALLOW, exact bytes below."""
    before = tuple(line[i - d : i])
    return (d, before if d > SHALLOW else tuple(classes[b] for b in before))


def plain_tree(training, classes):
    """The same mixture by recursion over nodes (context, bits so far)."""
    counts = collections.defaultdict(lambda: [0, 0])
    children = collections.defaultdict(set)
    for line in training:
        for i in range(DEPTH, len(line)):
            bits = f"{line[i]:08b}"
            for d in range(DEPTH + 1):
                for k in range(8):
                    node = node_of(line, i, d, classes), bits[:k]
                    counts[node][int(bits[k])] += 1
                    if d:
                        children[node_of(line, i, d - 1, classes), bits[:k]].add(node)

    @functools.cache
    def weighted(node):
        own = kt(*counts[node])
        if node[0][0] == DEPTH:
            return own
        return math.log(0.5) + np.logaddexp(own, sum(weighted(c) for c in children[node]))

    def score(line):
        total = 0.0
        for i in range(DEPTH, len(line)):
            bits = f"{line[i]:08b}"
            for k in range(8):
                p, left = 0.0, 1.0
                for d in range(DEPTH + 1):
                    node = node_of(line, i, d, classes), bits[:k]
                    if node not in counts:  # nothing below has been seen
                        p, left = p + left * 0.5, 0.0
                        break
                    n, keep = counts[node], 1.0
                    if d < DEPTH:
                        own = kt(*n)
                        keep = math.exp(own - np.logaddexp(own, sum(weighted(c) for c in children[node])))
                    p, left = p + left * keep * (n[1] + 0.5) / (sum(n) + 1), left * (1 - keep)
                total += math.log10(p if bits[k] == "1" else 1 - p)
        return total

    return score


def line_of(text):
    return [BOUNDARY] * DEPTH + list(lowered(text).encode()) + [BOUNDARY]


def check_scores(got, texts, training):
    by = collections.Counter(b for t in training for b in line_of(t)[DEPTH:])
    score = plain_tree([line_of(t) for t in training], byte_classes(by))
    for r in got:
        assert r["score"] == pytest.approx(score(line_of(texts[r["doc_id"]])), rel=1e-6)


@pytest.mark.parametrize("held, block", [(1 << 13, 32 << 20), (1, 1)])
def test_scores_are_the_recursive_mixture(spark, monkeypatch, held, block):
    """Whatever is held at once and however the texts fall into blocks; more letters than classes."""
    monkeypatch.setattr(lm, "HELD_GRAMS", held)
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    odd = "".join(chr(c) for c in range(0x430, 0x450)) + "!#$%&*+0123456789:;<=>?"
    training = ["abab", "abba é", "", "ba ba", prose(5, 40), prose(5, 40)[30:90] + odd, prose(6, 30), odd[::-1]]
    texts = dict(enumerate([*training[:3], "xyz", "baé b", prose(5, 40)[:50] + prose(6, 30), "日本語", odd * 2]))
    frame = documents(spark, [(None, t) for t in training])
    got = score_documents(documents(spark, list(texts.items())).coalesce(1), frame).collect()
    assert len(got) == len(texts)
    check_scores(got, texts, training)


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 2, 7.25, 1e3, 1e7])
    assert np.allclose(lgamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def test_odd_documents(spark):
    frame = documents(spark, ODD, score="x", row=1, n_tokens=2)
    got = score_documents(frame, frame).collect()
    assert len(got) == len(ODD) and all(r["score"] < 0 for r in got)
    check_base(got, dict(ODD), [t for _, t in ODD])
    empty = documents(spark, [])
    assert score_documents(empty, empty).collect() == []
    untrained = {r["doc_id"]: r for r in score_documents(frame, empty).collect()}
    assert untrained[4]["score"] == pytest.approx(5 * 8 * math.log10(0.5), rel=1e-5)
    assert untrained[4]["n_known"] == 0 and untrained[4]["train_tokens"] == 0 and untrained[4]["base_score"] == 0


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op6_lm_scoring"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    out = {d for d in texts if zlib.crc32(str(d).encode()) % 7 == 2}
    assert {r["doc_id"] for r in got if r["held_out"]} == out
    check_base(got, texts, [t for d, t in texts.items() if d not in out])
    held = [r["bits_per_byte"] for r in got if r["held_out"] and r["n_tokens"] > 50]
    assert sorted(held)[len(held) // 2] < 3


def plain_grams(text):
    line = line_of(text)
    return [int.from_bytes(bytes(line[i - DEPTH : i + 1])) for i in range(DEPTH, len(line))]


@pytest.mark.parametrize("texts", [["", ""], ["a"], ["", "ab", "", "é", "日本語 x"], [t or "" for _, t in ODD]])
def test_grams_are_found_where_they_stand(texts):
    """Each byte with those before it; a text's sum does not need its n-grams sorted."""
    found = np.concatenate([lm.grams(part) for part in chunks(pa.array(texts))])
    assert found.tolist() == [g for t in texts for g in plain_grams(t)]
    keys = lm.each_once(found)
    assert keys.tolist() == sorted(set(found.tolist())) and not len(lm.each_once(keys[:0]))
    mixed = np.random.default_rng(1).permutation(keys)
    assert (mixed[lm.Places(mixed.view(np.int64)).of(found)] == found).all()
    assert not len(lm.Places(mixed).of(keys[:0]))
    with pytest.raises(KeyError):
        lm.Places(mixed).of(np.array([1 << 60], np.uint64))
