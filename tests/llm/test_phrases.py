"""Collocations and count transducers against plain dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from quarry.llm import phrases as P
from tests.llm.brute import LOWER, ODD


def grams_of(text, m=3):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        w = re.findall(r"[^\x20\x09]+", piece)
        for k in range(1, m + 1):
            for i in range(len(w) - k + 1):
                yield tuple(w[i:i + k])


def brute(docs, least, m=3, share=0.5):
    by = {}
    for lang, text in docs:
        by.setdefault("und" if lang is None else lang, Counter()).update(grams_of(text, m))
    out = {}
    for lang, f in by.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        for g, a in often.items():
            if any(len(h) > len(g) and c >= share * a and any(h[i:i + len(g)] == g for i in range(len(h))) for h, c in often.items()):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            out[lang, " ".join(g)] = (a, k, f[g[:k]], f[g[k:]], n, score)
    return out


def corpus(seed=1, n=200):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "中文", "a-b", "\x01x"] + [f"w{k}" for k in range(40)]
    weights = [30, 5, 20, 6, 6, 4, 3, 2, 2, 1] + [1] * 40
    docs = [(rnd.choice(["en", "de", None, "und"]), "".join(rnd.choices(words, weights)[0] + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"])
                                                            for _ in range(rnd.randint(0, 80)))) for _ in range(n)]
    return docs + [("en", "new york city " * 30), ("odd", "x x x x x x x x x x x x x")] + [("en", t) for t in ODD]


@pytest.mark.parametrize("shard_words,union_arcs,m", [(P.SHARD_WORDS, P.UNION_ARCS, 3), (200, 300, 3), (200, 300, 2)])
def test_collocations_match_brute_force(spark, monkeypatch, shard_words, union_arcs, m):
    monkeypatch.setattr(P, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(P, "UNION_ARCS", union_arcs)
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, a int, phrase string").repartition(4)
    got = {(r["lang"], r["phrase"]): (r["a"], r["k"], r["l"], r["r"], r["n"], r["score"])
           for r in P.collocations(df, max_words=m, min_count=4).collect()}
    want = brute(docs, 4, m)
    assert len(want) > 50 and got == want


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_ties_rank_by_bytes(spark):
    rows = [("en", p, 5, s) for p, s in (("b a", 1), ("a z", 1), ("é a", 1), ("c c", 2))]
    got = P.top_phrases(spark.createDataFrame(rows, "lang string, phrase string, a long, score long"), 3).orderBy("rank").collect()
    assert [r["phrase"] for r in got] == ["c c", "a z", "b a"]


def test_a_text_longer_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_WORDS", 50)
    text = " ".join(f"k{i % 7}" for i in range(5000))
    got = {r["phrase"]: r["a"] for r in P.collocations(spark.createDataFrame([("en", text)], "lang string, text string"), inside_share=2.0).collect()}
    want = Counter(" ".join(g) for g in grams_of(text) if len(g) > 1)
    assert got == {p: c for p, c in want.items() if c >= 10}


def random_grams(rnd, n):
    c = Counter()
    for _ in range(n):
        g = tuple(rnd.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rnd.randint(1, 3)))
        c[g] += rnd.randint(1, 2)
    return c


def made(c):
    words = sorted({x for g in c for x in g})
    place = {x: k + 1 for k, x in enumerate(words)}
    keys = sorted(c)
    w = np.array([[place[x] for x in g] + [0] * (3 - len(g)) for g in keys], np.int64).reshape(-1, 3).T
    return P.Transducer.build(words, w, np.array([c[g] for g in keys], np.int64))


def read(t):
    w, n = t.ngrams()
    return {tuple(t.words[x - 1] for x in col if x): k for col, k in zip(w.T.tolist(), n.tolist())}


def test_transducers_round_trip_union_and_compose():
    rnd = random.Random(4)
    for n in (0, 1, 3, 20, 200):
        a, b = random_grams(rnd, n), random_grams(rnd, n)
        x, y = made(a), made(b)
        assert read(P.Transducer.loads(x.dumps())) == dict(a)
        assert read(P.union([x, y])) == dict(a + b)
        assert read(P.pruned(x, 2)) == {g: c for g, c in a.items() if c >= 2}
        w, k = x.compose(y)
        got = {tuple(x.words[i - 1] for i in col if i): c for col, c in zip(w.T.tolist(), k.tolist())}
        assert got == {g: b[g] for g in a if g in b}


def test_composition_keeps_paths_apart_that_share_a_state():
    asked = made(Counter({(b"a", b"x"): 1, (b"b", b"x"): 1}))
    assert len(asked.arcs[1][0]) == 1
    w, n = asked.compose(made(Counter({(b"a", b"x"): 3, (b"b", b"x"): 5, (b"b",): 9, (b"a", b"y"): 2})))
    assert sorted(n.tolist()) == [3, 5]


def test_long_texts_are_cut_between_pieces():
    text = b"ab cd. ef gh, ij kl; mn" * 9
    parts = list(P.sliced([text, b"", b"x y"], 10))
    assert b"".join(parts[:-2]) == text and len(parts) > 9 and parts[-2:] == [b"", b"x y"]
    assert all(p[-1:] in P.ENDS for p in parts[:-3])


def test_equal_futures_are_shared():
    c = Counter({(w, v): 1 for w in (b"a", b"b", b"c") for v in (b"x", b"y")})
    t = made(c)
    assert len(t.arcs[1][0]) == 2 and read(t) == dict(c)
