import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import ppm

PAD = bytes([ppm.START]) * ppm.ORDER


def brute(train, text):
    """PPM method C with exclusion, one byte at a time, from plain dictionaries."""
    follow = {}
    for t in train:
        t = PAD + ppm.modelled(t)
        for i in range(ppm.ORDER, len(t)):
            for k in range(ppm.ORDER + 1):
                follow.setdefault(t[i - k: i], Counter())[t[i]] += 1
    t, score = PAD + ppm.modelled(text), 0.0
    for i in range(ppm.ORDER, len(t)):
        out = set()
        for k in range(ppm.ORDER, -1, -1):
            c = follow.get(t[i - k: i])
            if c is None:
                continue
            left = {s: n for s, n in c.items() if s not in out}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if t[i] in left:
                score += math.log10(left[t[i]] / whole)
                break
            score += math.log10(len(left) / whole)
            out |= set(left)
        else:
            score -= math.log10(256 - len(out))
    return score


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(5)
    words = ["the", "then", "on", "one", "Éa", "x" * 9, "ab,", "to"]
    return [(k, " ".join(rnd.choices(words, k=rnd.randint(0, 40))) + rnd.choice(["", "\n zq", " "])) for k in range(60)] \
        + [(60, None), (61, ""), (62, "never ~ seen 中 before")]


def small_parts(monkeypatch, part, shards):
    monkeypatch.setattr(ppm, "COMMON_WORDS", 3)
    monkeypatch.setattr(ppm, "shuffle_partitions", lambda spark: shards)
    if part:
        for name, size in (("PART_BYTES", part), ("ASKED_BYTES", 3 * part), ("COUNTED", 5 * part), ("BATCH_ROWS", 7)):
            monkeypatch.setattr(ppm, name, size)


@pytest.mark.parametrize("part,shards", [(0, 8), (0, 1), (11, 5)])
def test_scores_match_brute_force(spark, corpus, monkeypatch, part, shards):
    small_parts(monkeypatch, part, shards)
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in corpus], "doc_id long, text string, word string, _id int").repartition(3)
    got = {r["doc_id"]: r for r in ppm.score_language(df).collect()}
    assert len(got) == len(corpus)
    learn = [(t or "").encode() for i, t in corpus if zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in learn for w in ppm.words_of(t))
    n, v = sum(c.values()) + len(learn), len(c) + 1
    for i, t in corpus:
        r, w = got[i], ppm.words_of((t or "").encode())
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((len(learn) + 0.5) / (n + 0.5 * (v + 1)))
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w) + 1, sum(x in c for x in w) + 1, n)
        assert r["base_score"] == pytest.approx(base, abs=1e-9)
        assert r["score"] == pytest.approx(brute(learn, (t or "").encode()), abs=1e-9)


@pytest.mark.parametrize("part,shards", [(0, 1), (13, 6)])
def test_repeated_rows_and_null_ids(spark, corpus, monkeypatch, part, shards):
    small_parts(monkeypatch, part, shards)
    docs = corpus + [corpus[0], corpus[0], (3, "zq on the"), (None, "the zq one"), (None, "the zq one"), (None, None), (None, "seen before")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    learn = [(t or "").encode() for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in learn for w in ppm.words_of(t))
    n, v = sum(c.values()) + len(learn), len(c) + 1

    def row(i, t):
        w = ppm.words_of((t or "").encode())
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((len(learn) + 0.5) / (n + 0.5 * (v + 1)))
        return (-1 if i is None else i, len(w) + 1, sum(x in c for x in w) + 1, round(base, 6), round(brute(learn, (t or "").encode()), 6))

    def rows(df, *cols):
        return sorted((-1 if r["doc_id"] is None else r["doc_id"], *[round(r[k], 6) for k in cols]) for r in df.collect())

    want = sorted(row(i, t) for i, t in docs)
    assert rows(ppm.score_language(df), "n_tokens", "n_known", "base_score", "score") == want
    train = df.where(ppm.in_training(df.doc_id))
    assert rows(ppm.ppm_scores(df, train), "score") == sorted((r[0], r[4]) for r in want)
    assert rows(ppm.base_scores(df, train), "n_tokens", "n_known", "base_score") == sorted(r[:4] for r in want)


def test_probabilities_sum_to_one(corpus):
    texts = [(t or "").encode() for _, t in corpus]
    g, n = np.unique(np.concatenate([ppm.grams(part)[0] for part in ppm.runs(texts, 100)]), return_counts=True)
    short = ppm.summed(g & 0xFFFFFF, n)
    whole = ppm.Trie(g, n, short)
    for context in (g[0] >> 8, g[len(g) // 2] >> 8, 0x4142434445):
        asked = (int(context) << 8) + np.arange(256)
        p = whole.log10(asked)
        assert (10 ** p).sum() == pytest.approx(1)
        # a shard knows as much of its contexts as the whole trie
        for s, at in ppm.by_shard(asked, 7):
            own = ppm.shard_of(g, 7) == s
            assert np.allclose(ppm.Trie(g[own], n[own], short).log10(asked[at]), p[at], atol=1e-12)


@pytest.mark.parametrize("size", [1, 2, 5, 64])
def test_long_texts_are_cut_without_a_trace(monkeypatch, size):
    rnd = random.Random(size)
    texts = ["".join(rnd.choice("ab\t\n  É") for _ in range(rnd.randint(0, 60))).encode() for _ in range(80)]
    want = [b" ".join(ppm.words_of(t)) + bytes([ppm.END]) for t in texts]
    monkeypatch.setattr(ppm, "PART_BYTES", size)
    assert [ppm.modelled(t) for t in texts] == want
    cut = [ppm.grams(part)[0] for part in ppm.runs(texts, 7)]
    monkeypatch.setattr(ppm, "PART_BYTES", 1 << 20)
    assert np.array_equal(np.concatenate(cut), np.concatenate([ppm.grams(part)[0] for part in ppm.runs(texts, 1 << 20)]))


def test_one_very_long_text(spark):
    text = "on the other hand " * 300_000  # 5.4 MB: three pieces
    df = spark.createDataFrame([(0, text), (2, "on the hand")], "doc_id long, text string")
    r = {x["doc_id"]: x["score"] for x in ppm.ppm_scores(df, df).collect()}
    assert r[0] / len(text) > -0.001 and r[2] < -1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.score_language(df).collect() == []
    one = spark.createDataFrame([(3, "only held out?")], "doc_id long, text string")
    r = ppm.ppm_scores(one, one.limit(0)).first()
    assert r["score"] == pytest.approx(-len(b"only held out?\n") * math.log10(256))
