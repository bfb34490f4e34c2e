import hashlib
import itertools
import random
import re
import zlib

import pytest
from fixtures import table

from tallymill.llm import conversations as C
from tallymill.llm.queries import QUERIES

GOOD = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def repairs(roles, found, most):
    """Every repair with at most ``most`` insertions at any one place, by trying all of them."""
    inserts = [x for n in range(most + 1) for x in itertools.product("ua", repeat=n)]
    best = None
    choices = []
    for role, fault in zip(roles, found):
        edits = [("D", 3, "")]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            edits += [("K", extra, role[:1]), ("R", 2 + extra, "u"), ("R", 2 + extra, "a")]
        choices.append(edits)
    for picked in itertools.product(*choices):
        for put in itertools.product(inserts, repeat=len(roles) + 1):
            initials = "".join("".join(p) + e[2] for p, e in zip(put, picked)) + "".join(put[-1])
            if GOOD.match(initials):
                audit = "".join("I" * len(p) + e[0] for p, e in zip(put, picked)) + "I" * len(put[-1])
                cost = sum(e[1] for e in picked) + 2 * sum(map(len, put))
                key = (cost, audit, tuple(e[2] for e in picked))
                best = key if best is None or key < best else best
    return best


def cheapest(roles, found):
    """The least (cost, audit) over all positions and states, as strings, by Bellman's equation from the end."""
    step = {"0": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
    inf = (10**9, "")
    best = {("0", len(roles)): (0, ""), ("A", len(roles)): (0, "")}
    for i in range(len(roles), -1, -1):
        if i < len(roles):
            for q in step:
                options = [(3, "D", q)]
                if found[i] not in ("blank", "duplicate"):
                    extra = found[i] == "truncated"
                    options += [(extra, "K", step[q][roles[i][:1]])] if roles[i][:1] in step[q] else []
                    options += [(2 + extra, "R", t) for x, t in step[q].items() if x != "s"]
                best[q, i] = min((c + best[t, i + 1][0], e + best[t, i + 1][1]) for c, e, t in options)
        for _ in range(4):
            for q in step:
                for x, t in step[q].items():
                    if x != "s":
                        c, a = best.get((t, i), inf)
                        best[q, i] = min(best.get((q, i), inf), (c + 2, "I" + a))
    return best["0", 0]


def edited(rows, audit):
    out, k, initials = [], 0, ""
    for edit in audit:
        if edit in "IR":
            role = "assistant" if initials[-1:] == "u" else "user"
            out.append((role, "" if edit == "I" else rows[k][3]))
        elif edit == "K":
            out.append(rows[k][2:])
        if edit != "D":
            initials += out[-1][0][:1]
        k += edit != "I"
    assert GOOD.match(initials) and k == len(rows)
    return out


def plain(rows, hurt=damage):
    after = hurt(rows)
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(mine)
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest([r[2] for r in mine], found)
        text = "\n".join(f"{r}:{t}" for r, t in edited(mine, audit))
        count = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append(str((conv, gaps, *count, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())))
    return sorted(out)


def shown(frame):
    return sorted(str(tuple(r[n] for n in C.SUMMARY)) for r in frame.collect())


def conversations(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "'x' AS conv", "7 AS n", "1 AS part", "'y' AS audit").repartition(3)


def test_edits_against_all_repairs():
    """Both plain versions and the parser agree on every short conversation."""
    for n in range(4):
        for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=n):
            for found in itertools.product(["", "truncated", "blank"] if n < 3 else ["", "blank"], repeat=n):
                parse = C.Parse()
                for role, fault in zip(roles, found):
                    parse.row(role[:1], fault == "blank", fault == "truncated")
                got = C.accepted(parse.found())
                assert got == cheapest(roles, found)
                if n < 3:
                    assert got == repairs(roles, found, 2)[:2]


def talk(seed, n, conv):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Is it?", "and then", "", " \t", "Well. ", "a.b", None, " ", "é."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None, "u"]
    turns = [None, *range(max(1, n))]
    return [(conv, rng.choice(turns), rng.choice(roles), rng.choice(texts) and rng.choice(texts)) for _ in range(n)]


ODD = (
    [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (2, None, None, None), (None, 1, "user", "x"), (None, None, "assistant", "x.")]
    + [(3, 5, "system", "s."), (3, 9, "user", "u" * 200000), (3, 9, "user", "u" * 200000), (4, 7, "user", "q?"), (-5, -3, "user", "q?")]
    + [(100 + i, 0, "user", "Only row.") for i in range(40)]
)


@pytest.mark.parametrize("long, piece", [(4096, 1 << 20), (0, 1 << 20), (6, 30)])
def test_odd_conversations(spark, monkeypatch, long, piece):
    """Parsed whole and, with a small limit, in parts."""
    monkeypatch.setattr(C, "PIECE", piece)
    rows = ODD + [r for i in range(40) for r in talk(i, i % 14, 200 + i)]
    frame = conversations(spark, rows)
    got = C.repair(C.damaged(frame), copies=C.F.col("copies"), long=long)
    assert shown(got.summary) == plain(rows)
    digest = {}
    for r in sorted(got.turns.collect(), key=lambda r: (r["part"], r["piece"], r["position"])):
        digest.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in got.summary.collect():
        assert hashlib.sha256("\n".join(digest.get(r["conv_id"], [])).encode()).hexdigest() == r["repaired_sha256"]


def test_one_long_conversation(spark):
    """Most rows in one conversation, many of them equal; its parts lie in several tasks."""
    rows = talk(1, 900, 1) + talk(2, 5, 2) + [(1, 3, "user", "Again.")] * 300
    assert shown(C.repair(conversations(spark, rows), long=50).summary) == plain(rows, lambda x: [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in x])


def test_empty_table(spark):
    assert C.repaired_conversations(conversations(spark, [])).collect() == []


def test_query(spark, sf_dir):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, sf_dir, "conversations").collect()]
    assert shown(QUERIES["op12_conversation_repair"](spark, sf_dir)) == plain(rows)
