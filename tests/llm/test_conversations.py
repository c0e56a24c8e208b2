"""Conversation repair against a plain row-by-row search."""

import hashlib
import random
import re

import pytest

from quarry.llm import conversations as C

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}


def brute(rows):
    """The report and repaired rows of one conversation, (turn, role, text) a row."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    out = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    turns = [t for t, _, _ in rows if t is not None]
    if turns:
        out["gaps"] = max(turns) - min(turns) + 1 - len(set(turns))
    for (_, a, _), (_, b, _) in zip(rows, rows[1:]):
        out["illegal"] += a[:1] + b[:1] not in ("su", "ua", "au")
    seen, ways = set(), {0: (0, "", ())}

    def inserted(ways):
        todo = dict(ways)
        for _ in range(3):
            for s, (c, e, o) in list(todo.items()):
                i = "a" if s == 2 else "u"
                way = (c + 5, e + "I", o + ((ROLE[i], ""),))
                t = NEXT[s, i]
                todo[t] = min(todo.get(t, way), way)
        return todo

    for _, role, text in rows:
        full = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            out[fault] += 1
        new = {}
        # a state that is entered by inserts may also be left without them, so all ways are kept apart
        starts = [(s, w) for s, w in ways.items()]
        every = []
        for s, w in starts:
            c, e, o = w
            every.append((s, w))
            for _ in range(2):
                i = "a" if s == 2 else "u"
                c, e, o, s = c + 5, e + "I", o + ((ROLE[i], ""),), NEXT[s, i]
                every.append((s, (c, e, o)))
        for s, (c, e, o) in every:
            offers = [(s, (c + 2, e + "D", o))]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (s, role[:1]) in NEXT:
                    offers.append((NEXT[s, role[:1]], (c + more, e + "K", o + ((role, text),))))
                for i in "ua":
                    if (s, i) in NEXT:
                        offers.append((NEXT[s, i], (c + 1 + more, e + "R", o + ((ROLE[i], text),))))
            for t, way in offers:
                new[t] = min(new.get(t, way), way)
        ways = new
    cost, audit, done = min(w for s, w in inserted(ways).items() if s in (0, 3))
    return out | {"cost": cost, "audit": audit}, list(done)


def random_conversations(seed, n, longest):
    rnd = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rnd.randint(1, longest)):
            turn = None if rnd.random() < 0.1 else rnd.randint(0, longest)
            out.append((c if c else None, turn, rnd.choice(["user", "assistant", "system", "tool", "user", "assistant", None, "", "student"]),
                        rnd.choice(["a.", "b!", "c", "", None, " \n", "long " * 40 + "?", "é."]) if rnd.random() < 0.7 else f"t{t}." + " " * rnd.randint(0, 2)))
    return out


@pytest.mark.parametrize("chunk,max_rules,longest", [(C.CHUNK, C.MAX_RULES, 9), (3, C.MAX_RULES, 25), (4, 0, 25)])
def test_repair_matches_brute_force(spark, chunk, max_rules, longest):
    data = random_conversations(chunk % 97, 25, longest)
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "conv_id long, turn long, role string, text string, place int, _conv string").repartition(5)
    report, rows = C.repair_conversations(df, chunk=chunk, max_rules=max_rules)
    got = {r["conv_id"]: r.asDict() for r in report.collect()}
    done = {}
    for r in rows.collect():
        done.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"]))
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in C.conversation_hashes(rows).collect()}
    ids = {r[0] for r in data}
    assert set(got) == ids
    for c in ids:
        want, lines = brute([r[1:] for r in data if r[0] == c])
        assert {k: got[c][k] for k in want} == want, c
        mine = sorted(done.get(c, []))
        assert [(r, x) for _, r, x, _ in mine] == lines
        assert "".join(e for *_, e in mine) == want["audit"].replace("D", "")
        if lines:
            assert hashes[c] == hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()
        else:
            assert c not in hashes


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, rows = C.repair_conversations(df)
    assert report.count() == 0 and rows.count() == 0


def test_hot_conversation_is_cut_into_chunks(spark):
    """A third of the rows in one conversation, half of them the same row."""
    rows = [(1, t // 2, "user" if t % 2 else "assistant", "same." if t % 3 else f"x{t}") for t in range(3000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(2, 800) for t in range(5)]
    report, _ = C.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chunk=200)
    got = {r["conv_id"]: r.asDict() for r in report.collect()}
    assert len(got) == 799
    want, _ = brute([r[1:] for r in rows if r[0] == 1])
    assert {k: got[1][k] for k in want} == want
    assert all(got[c]["cost"] == 2 and got[c]["audit"] == "KKKKD" for c in range(2, 800))


def test_rules_do_not_change_matrices():
    rnd = random.Random(3)
    symbols = [rnd.randrange(C.TERMINALS) for _ in range(40)]
    made, parts = C.evaluated([(0, 1), (9, 9), (10, 3)])
    ropes = C.Ropes(parts)

    def whole(seq):
        m = made[seq[0]]
        for s in seq[1:]:
            m = ropes.product(m, made[s])
        return ropes.whole(m)

    assert whole([11, *symbols]) == whole([0, 1, 0, 1, 3, *symbols])


def test_damage(spark):
    import zlib

    data = [(c, t, r, x) for c in (1, None) for t in (*range(60), None) for r, x in (("assistant", "A. b!"), (None, None))]
    got = C.damaged(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, r, x in data:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)
        want += [] if k == 0 else [row] * (2 if k == 3 else 1)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
