"""Personal data against plain regular expressions and planted cases."""

import hashlib
import random
import re

import pytest

from quarry.llm import private_data as V
from tests.llm.brute import ODD

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if good(k, m[0])]


def card(rnd, n=16):
    d = "4" + "".join(rnd.choice("0123456789") for _ in range(n - 2))
    return next(d + c for c in "0123456789" if luhn(d + c))


def soup(rnd):
    parts = ["a", "b.c", "@", "x@y.z", "a@b.c.@d.e", "a@b.c%x@d.e-f.g", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000255.01.1.1", "+1 (743) 555-3824",
             "+", "++49 30 1234567", "+1 2", "4465758382889437", card(rnd), card(rnd, 19), "1234 5678-9012 3456", "5", " ", "  ", "-", ".", "(", ")", "é", "中",
             "\U0001f600", "\n", "%", "v1.2.3.4", "12", "+1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6"]
    return "".join(rnd.choice(parts) + rnd.choice(["", "", " "]) for _ in range(rnd.randint(0, 25)))


@pytest.fixture(scope="module")
def scanned(spark):
    rnd = random.Random(8)
    docs = [(k, soup(rnd)) for k in range(400)] + [(1000 + k, t) for k, t in enumerate(ODD)]
    docs += [(2000, "9" * 30000), (2001, "a." * 20000 + "@"), (2002, "+5" + "(" * 20000), (2003, "1." * 20000), (2004, "x@" + "y." * 20000 + "z"),
             (2005, "1 " * 20000), (None, "n@m.org"), (None, "n@m.org")]
    df = spark.createDataFrame([(*d, 1, "k") for d in docs], "doc_id long, text string, start int, kind string").repartition(4)
    return docs, V.private_spans(df).collect()


def test_base_spans_match_plain_patterns(scanned):
    docs, got = scanned
    assert len(got) == len(docs)
    text = dict(docs)
    for r in got:
        mine = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]
        assert mine == base(text[r["doc_id"]]), r["doc_id"]
        order = [(V.KINDS.index(s["kind"]), s["start"]) for s in r["spans"]]
        assert order == sorted(order)
        for s in r["spans"]:
            assert (text[r["doc_id"]] or "")[s["start"]:s["end"]] == s["match"]


def test_added_spans_touch_no_base_span(scanned):
    for r in scanned[1]:
        fixed = [(s["start"], s["end"]) for s in r["spans"] if s["base"]]
        more = sorted((s["start"], s["end"]) for s in r["spans"] if not s["base"])
        assert all(e <= a or s >= b for s, e in more for a, b in fixed)
        assert all(x[1] <= y[0] for x, y in zip(more, more[1:]))


def test_planted_spellings_are_added_and_clean_texts_stay_clean(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("aeinrst") for _ in range(rnd.randint(2, 7)))
    prose = lambda: " ".join(word() for _ in range(20))
    kinds = {"email": lambda: f"{word()}.{word()} [at] {word()} [dot] com", "phone": lambda: f"({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}",
             "card": lambda: card(rnd, 15)}
    docs, planted = [], {}
    for k in range(400):
        kind = rnd.choice([*kinds, "", "", "number", "plain"])
        if kind in kinds:
            planted[k] = (kind, kinds[kind]())
            docs.append((k, f"{prose()} {planted[k][1]} {prose()}."))
        elif kind == "number":
            bad = card(rnd)  # a card number but for its check digit, and digits within a word
            docs.append((k, f"{prose()} {bad[:-1]}{(int(bad[-1]) + 1) % 10} x{card(rnd, 15)}y"))
            docs.append((1000 + k, f"{prose()} version 3.{rnd.randint(300, 999)}.1.{rnd.randint(1, 9)} and {rnd.randint(10, 99999)} {prose()}"))
        elif kind == "plain":
            docs.append((k, f"{prose()} {word()}@{word()}.com or +1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}, {card(rnd)} {prose()}"))
        else:
            docs.append((k, prose()))
    got = {r["doc_id"]: r["spans"] for r in V.private_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hit = sum(any((s["kind"], s["match"]) == p for s in got[k]) for k, p in planted.items())
    assert hit >= 0.9 * len(planted)
    clean = [k for k, t in docs if k not in planted and "@" not in t]
    assert sum(bool(got[k]) for k in clean) <= 0.02 * len(clean)


def test_reliabilities_find_the_labeler_that_guesses():
    rnd = random.Random(6)
    counts = {}
    for _ in range(5000):
        y = rnd.random() < 0.3
        v = tuple(0 if k == "form" else (1 if y else -1) if rnd.random() < (0.5 if k == "cue" else 0.85) else (-1 if y else 1) for k in V.LABELERS)
        counts[v] = counts.get(v, 0) + 1
    share, said, post = V.reliabilities([(dict(zip(V.LABELERS, v)), float(n)) for v, n in counts.items()])
    assert abs(share - 0.3) < 0.03
    assert abs(said["shape", 1][1] - 0.85) < 0.03 and abs(said["cue", 1][1] - 0.5) < 0.06


def test_empty_table_and_digest(spark):
    assert V.private_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    from pyspark.sql import functions as F

    df = V.private_spans(spark.createDataFrame([(1, "q@r.de 1.2.3.4"), (2, None)], "doc_id long, text string"))
    got = {r[0]: r[1] for r in df.select("doc_id", F.sha2(V.span_list(F.col("spans")), 256)).collect()}
    assert got == {1: hashlib.sha256(b"email:0:6,ip:7:14").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
