import tracemalloc

import numpy as np
import pyarrow as pa
from fixtures import ODD, shingles, word_list
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymill.llm import text as T
from tallymill.llm.spread import forest, groups


def every_word(texts, size):
    out = []
    for part in T.chunks(pa.array(texts, pa.string()), size):
        found = T.words(part)
        raw = part.data.tobytes()
        for i in range(len(part)):
            span = slice(found.bounds[i], found.bounds[i + 1])
            out.append(
                [
                    (raw[s:e].decode(), int(h))
                    for s, e, h in zip(found.starts[span], found.ends[span], found.hashes[span])
                ]
            )
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="abZ é.\n0ß\x00😀", max_size=30), max_size=8), st.integers(1, 40))
def test_words_of_any_texts_in_any_chunks(texts, size):
    found = every_word(texts, size)
    assert [["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w, _ in row] for row in found] == [
        word_list(t) for t in texts
    ]
    by = {}
    for row in found:
        for w, h in row:
            assert by.setdefault(w.lower() if w.isascii() else w, h) is not None
    assert len(set(by.values())) == len(by) or any(not w.isascii() for w in by)


def test_a_hash_depends_on_the_lowered_word_alone():
    rows = every_word(["The cat", "x the", None, "THE"], 3)
    hashes = {w.lower(): h for row in rows for w, h in row}
    assert rows[0][0][1] == rows[1][1][1] == rows[3][0][1] == hashes["the"]
    assert T.hash_words("the cat").tolist() == [hashes["the"], hashes["cat"]]


def test_shingles_agree_across_texts():
    texts = [t for _, t in ODD] + ["a b c d e f", "b c d e f g", "a b", "A, B!"]
    sets = []
    for part in T.chunks(pa.array(texts, pa.string())):
        hashes, bounds = T.shingle_hashes(T.words(part), 5)
        sets += [set(hashes[bounds[i] : bounds[i + 1]].tolist()) for i in range(len(part))]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


def test_groups_across_batches():
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "b"), (3, "a")]
    table = pa.table({"k": [r[0] for r in rows], "s": [r[1] for r in rows]})
    for size in (1, 2, 4, 9):
        got = [g.to_pylist() for g in groups(table.to_batches(max_chunksize=size), ["k", "s"])]
        assert [len(g) for g in got] == [2, 1, 2, 1]


def test_forest_finds_components():
    a, b = np.array([5, 4, 3, 1]), np.array([4, 3, 2, 0])
    assert forest(7, a, b).tolist() == [0, 0, 2, 2, 2, 2, 6]


def thue_morse(k):
    word = "a"
    for _ in range(k):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_made_to_collide():
    for k in (9, 10, 11, 12):
        rows = every_word([" ".join(thue_morse(k))], 1 << 20)
        assert len({h for _, h in rows[0]}) == 2


def test_a_long_word_is_hashed_in_pieces(monkeypatch):
    texts = ["abcdefghijklmnopqrstuvwxyz0123456789 abc", "ABC abcdefghijklmnopqrstuvwxyz0123456789"]
    whole = every_word(texts, 1 << 20)
    monkeypatch.setattr(T, "CHUNK_BYTES", 8)
    assert every_word(texts, 1 << 20) == whole
    assert whole[0][0][1] == whole[1][1][1] and whole[0][1][1] == whole[1][0][1]


def test_span_hashes_do_not_depend_on_the_stretch(monkeypatch):
    part = next(T.chunks(pa.array(["0123456789" * 20])))
    starts = np.arange(0, 190)
    whole = T.span_hashes(part, starts, starts + 10)
    monkeypatch.setattr(T, "CHUNK_BYTES", 7)
    assert (T.span_hashes(part, starts, starts + 10) == whole).all() and len(set(whole.tolist())) == 10


def test_memory_of_a_long_text():
    part = next(T.chunks(pa.array(["lorem ipsum " * (40_000_000 // 12)])))
    T.words(next(T.chunks(pa.array(["a b"]))))
    tracemalloc.start()
    found = T.words(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(found.hashes[:100].tolist())) == 2 and peak < 500e6
