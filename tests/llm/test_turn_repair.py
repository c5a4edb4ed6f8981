"""Conversation repair against a plain walk over all states with whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from patronage.llm import turn_repair as T

TURNS = "conv_id long, turn long, role string, text string"


def closure(ways):
    out, todo = dict(ways), list(ways)
    while todo:
        s = todo.pop()
        c, a = out[s]
        t, n = T.STEPS[s, T.WANTED[s]], (c + 3, a + "I")
        if t not in out or n < out[t]:
            out[t] = n
            todo.append(t)
    return out


def slow(symbols):
    ways = {0: (0, "")}
    for x in symbols:
        new = {}
        for s, (c, a) in closure(ways).items():
            options = [(s, c + 4, "D")]
            if x != "x":
                more = 3 if x.isupper() else 0
                if (s, x.lower()) in T.STEPS:
                    options.append((T.STEPS[s, x.lower()], c + more, "K"))
                options.append((T.STEPS[s, T.WANTED[s]], c + more + 3, "R"))
            for t, cost, letter in options:
                new[t] = min(new.get(t, (10 ** 9, "")), (cost, a + letter))
        ways = new
    return min(v for t, v in closure(ways).items() if t in T.ENDS)


def slow_repair(rows):
    """The whole answer of one conversation from its rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, symbols, count = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = re.sub("[\x20\x09-\x0D]+$", "", text)
        first = role[:1] if role[:1] in ("s", "u", "a") else "o"
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        if fault:
            count[fault] += 1
        seen.add((role, text))
        symbols += {"": first, "truncated": first.upper()}.get(fault, "x")
    cost, audit = slow(symbols)
    out, left, state = [], list(rows), 0
    for c in audit:
        role, text = (None, "") if c == "I" else left.pop(0)[1:]
        if c == "D":
            continue
        role = role if c == "K" else T.NAMES[T.WANTED[state]]
        state = T.STEPS[state, role[0]]
        out.append(f"{role}:{text}")
    heads = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count.values(),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:], strict=False)), cost, audit, out)


def test_matrices_equal_the_walk_whatever_the_bracketing():
    rng = random.Random(0)
    seqs = ["".join(rng.choice(rng.choice(["ua", "suaoSUAOx", "uaUAx"])) for _ in range(rng.choice([0, 1, 3, 8, 30, 150])))
            for _ in range(300)]
    for s, m in zip(seqs, T.transfers(seqs), strict=True):
        cost, audit = T.finish(m)
        assert (cost, str(audit)) == slow(s)
    for s in seqs[:120]:
        k = rng.randint(1, 9)
        cut = [s[i:i + k] for i in range(0, len(s), k)] or [""]
        found = [{"stretch": i, "illegal": 0, "head": "u", "tail": "a", "matrix": [
            {"f": f, "t": t, "cost": c, "audit": str(a)} for (f, t), (c, a) in m.items()]} for i, m in enumerate(T.transfers(cut))]
        cost, audit, _, parts = T.joined(found)
        assert (cost, audit) == slow(s) and "".join(p[2] for p in parts) == audit


def test_every_short_sequence():
    seqs = [""]
    for _ in range(4):
        seqs = [""] + [a + b for a in seqs for b in T.BASE]
    seqs = sorted(set(seqs))
    for s, m in zip(seqs, T.transfers(seqs), strict=True):
        cost, audit = T.finish(m)
        assert (cost, str(audit)) == slow(s), s


def test_re_pair_gives_back_its_sequences():
    rng = random.Random(3)
    seqs = ["".join(rng.choice("uaUx") for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["aaaaaaaaaaa", "a", ""]
    rules, packed = T.re_pair(seqs)

    def open_(s):
        return "".join(open_(rules[c]) if c in rules else c for c in s)
    assert [open_(s) for s in packed] == seqs
    assert sum(map(len, packed)) < sum(map(len, seqs)) / 2
    pairs = [a + b for s in packed for a, b in zip(s, s[1:], strict=False)]
    assert max(map(pairs.count, pairs)) == 1 or len(pairs) < 2


def test_ropes_compare_as_strings():
    rng = random.Random(4)
    words = ["".join(rng.choice("DIKR") for _ in range(rng.randint(0, 12))) for _ in range(60)]
    words += [w + "K" for w in words[:20]] + [w[:-1] + "D" for w in words[:20]]
    for x in words:
        for y in words:
            assert (T.text_rope(x) < T.text_rope(y)) == (x < y)
        cut = rng.randint(0, len(x))
        assert str(T.text_rope(x[:cut]) + T.text_rope(x[cut:])) == x


def case(seed, n):
    rng = random.Random(seed)
    said = [f"line {i}{rng.choice('.!?,')}" for i in range(max(3, n // 2))] + ["", " \n", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None]
    return [(rng.choice([i, i, None if rng.random() < .1 else i, max(0, i - 2)]), rng.choice(roles[:2] if rng.random() < .7 else roles),
             rng.choice(said)) for i in range(n)]


@pytest.fixture(scope="module")
def cases():
    out = {i: case(i, i % 9) for i in range(1, 60)}
    out[900], out[901] = case(900, 1500), [(i, ("user", "assistant")[i % 2], f"t{i}.") for i in range(1300)]
    out[902] = [(None, "user", "same.")] * 1100 + [(1, "assistant", "b.")] * 3
    out[None] = case(77, 12)
    return out


def test_repair_equals_the_walk(spark, cases):
    rows = [(i, *r) for i, rs in cases.items() for r in rs]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 key", "'a' stretch", "2 pos", "3 copies", "'x' symbols", "4 blank")
    summary, repaired = T.repair(frame, spark.createDataFrame([(i,) for i in (*cases, 5000)], "conv_id long"))
    turns = {}
    for r in sorted(repaired.collect(), key=lambda r: r["stretch"]):
        turns.setdefault(r["conv_id"], []).extend(f"{t['role']}:{t['text']}" for t in r["turns"])
    got = {r["conv_id"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")],
                          turns.get(r["conv_id"], [])) for r in summary.collect()}
    assert got == {**{i: slow_repair(rs) for i, rs in cases.items()}, 5000: (0, 0, 0, 0, 0, 0, "", [])}


def test_damage_and_digests(spark):
    ids = range(40)
    rows = [(i, t, ("user", "assistant")[t % 2], f"Say {i}.{t}! Yes? No.") for i in ids for t in range(5)]
    rows += [(None, 1, None, None), (None, None, "user", "x."), (70, None, "tool", "a.b")]
    want = {}
    for i, t, role, text in rows:
        h = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        kept = want.setdefault(i, [])
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            kept += [(t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    got = {r["conv_id"]: tuple(r)[1:] for r in T.repair_digests(spark.createDataFrame(rows, TURNS)).collect()}
    for i, rs in want.items():
        w = slow_repair(rs)
        assert got[i] == (*w[:-1], hashlib.sha256("\n".join(w[-1]).encode()).hexdigest())
    assert T.repair_digests(spark.createDataFrame([], TURNS)).collect() == []
