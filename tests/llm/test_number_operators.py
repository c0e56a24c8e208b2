"""Packing, mixing, token files, top-k search and the pipeline against brute force and on awkward rows."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import token_files as tf
from quarry.llm.encoding import Encoder, public_path
from quarry.llm.mixing import mix_sources
from quarry.llm.packing import (Fillings, Sizes, best_fit, cut_pieces, least_bins, pack_documents, pack_pieces, pack_sizes, repacked,
                                searched, sequences)
from quarry.llm.topk import exact_top_k
from tests.llm.brute import ODD, words


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_path())


def encoded(tokenizer, text, end):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---- token ids

@pytest.mark.parametrize("kept, joined", [(1_500_000, 500), (40, 500), (1_500_000, 3)])
def test_encoder_is_the_tokenizers(tokenizer, monkeypatch, kept, joined):
    from quarry.llm import encoding
    monkeypatch.setattr(encoding, "CACHED_WORDS", kept)
    monkeypatch.setattr(encoding, "JOINED_WORDS", joined)
    rnd = random.Random(1)
    bits = ["the", " ", "  ", "\n", "\n\n", "\t", "it's", "'LL", "é", "中文", "12,345", "!!", "\xa0", " ", "\x85", "<|endoftext|>", "🙂", "a" * 300, "\r\n", " \n "]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(0, 30))) for _ in range(400)] + [t for t in ODD if t is not None]
    texts += [" ".join(rnd.choices(["one", "two.", "Three", "x\ny"], k=20)) + rnd.choice(["", " ", "\n"]) for _ in range(100)]
    enc = Encoder(public_path())
    for _ in range(2):  # the second time from the cache
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_keeps_the_words_at_hand_when_its_cache_is_full(monkeypatch):
    from quarry.llm import encoding
    monkeypatch.setattr(encoding, "CACHED_WORDS", 3)
    enc, learned = Encoder(public_path()), []
    learn = enc._learn
    monkeypatch.setattr(enc, "_learn", lambda new: (learned.append(sorted(new)), learn(new)))
    for text in ("x one two three", "x one two three four", "x four one"):
        enc.encode([text])
    assert learned == [["one", "three", "two"], ["four"], []]


# ---- token files

def test_codes_read_any_token():
    rnd = np.random.default_rng(2)
    for ids in [np.zeros(0, np.uint32), np.array([0]), rnd.integers(0, 50_000, 3000), rnd.integers(0, 200, 700),
                np.concatenate([rnd.integers(0, 300, 1030), [2 ** 32 - 1, 2 ** 16, 255, 256]])]:
        raw = tf.to_bytes(ids.astype(np.uint32), [1], np.array([0, len(ids)]))
        codes = tf.TokenFile(raw).codes
        assert codes.read(0, len(ids)).tolist() == ids.tolist()
        assert [codes[k] for k in range(0, len(ids), 7)] == ids[::7].tolist()
        for _ in range(20):
            a, b = sorted(rnd.integers(0, len(ids) + 1, 2).tolist())
            assert codes.read(a, b).tolist() == ids[a:b].tolist()
        with pytest.raises(IndexError):
            codes[len(ids)]
    with pytest.raises(ValueError):
        tf.TokenFile(raw[:-1])


def test_token_files_round_trip(spark, tokenizer):
    docs = [(k * 7 - 20, t) for k, t in enumerate(ODD * 3)] + [(5000, "word " * 9000), (None, "null id")]
    df = spark.createDataFrame([(i, t, 3) for i, t in docs], "doc_id long, text string, start int").repartition(4)
    folder = tf.token_folder(spark)
    index = tf.write_token_files(df, public_path(), folder, end_id=2, file_tokens=500)
    assert index.count() > 3
    got = tf.read_token_files(spark, index, folder, keep_ids=True).collect()
    at = 0
    by_id = {r["doc_id"]: r for r in got}
    for i, t in sorted(docs, key=lambda r: (r[0] is None, r[0])):
        ids = encoded(tokenizer, t, 2)
        r = by_id[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"], np.frombuffer(r["ids"], "<u4").tolist()) == (at, len(ids), crc(ids), ids)
        at += len(ids)
    assert len(got) == len(docs)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tf.read_token_files(spark, tf.write_token_files(empty, public_path(), folder), folder).collect() == []


# ---- packing

def test_pack_sizes_is_whole_and_near_the_bound():
    rnd = random.Random(3)
    for _ in range(150):
        cap = rnd.choice([10, 100, 2048])
        sizes = Counter(rnd.randint(1, cap) for _ in range(rnd.randint(0, 60)))
        bins = pack_sizes(sizes, cap)
        assert Counter(s for b in bins for s in b) == sizes and all(sum(b) <= cap for b in bins)
        assert len(bins) <= len(best_fit(sizes, cap))


def test_pack_sizes_repacks_the_bins_that_are_not_full():
    """The search of all bins alone ends one bin above the bound here."""
    rnd = random.Random(13)
    sizes = Counter(min(2048, int(rnd.lognormvariate(6.7, 0.9)) + 1) for _ in range(1000))
    bins = pack_sizes(sizes, 2048, 300)
    assert Counter(s for b in bins for s in b) == sizes and all(sum(b) <= 2048 for b in bins)
    assert len(bins) == least_bins(sizes, 2048) < len(searched(best_fit(sizes, 2048), 2048, 300))


def test_repacked_picks_other_bins_where_the_first_do_not_help():
    """Parts that only grow end one bin above the bound here."""
    rnd = random.Random(166)
    sizes = Counter(min(2048, int(rnd.lognormvariate(6.7, 0.9)) + 1) for _ in range(1000))
    best, bound = best_fit(sizes, 2048), least_bins(sizes, 2048)
    bins = repacked(best, 2048, bound, 300)
    assert Counter(s for b in bins for s in b) == sizes and all(sum(b) <= 2048 for b in bins)
    assert len(bins) == bound < len(best)
    assert bins == repacked(best, 2048, bound, 300)


def test_pack_sizes_finds_the_optimum():
    """Against exhaustive search on small cases."""
    def least(items, cap):
        best = len(items)

        def place(k, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if k == len(items):
                best = len(rooms)
                return
            for j in range(len(rooms)):
                if rooms[j] >= items[k] and rooms[j] not in rooms[:j]:
                    place(k + 1, rooms[:j] + [rooms[j] - items[k]] + rooms[j + 1:])
            place(k + 1, rooms + [cap - items[k]])
        place(0, [])
        return best

    rnd = random.Random(4)
    off = 0
    for _ in range(60):
        items = sorted((rnd.randint(8, 60) for _ in range(9)), reverse=True)
        off += len(pack_sizes(Counter(items), 100)) - least(items, 100)
    assert off == 0
    # best-fit decreasing needs four bins here, three do
    assert len(best_fit(Counter([6, 5, 5, 4, 3, 3, 2, 2]), 10)) >= 3 and len(pack_sizes(Counter([6, 5, 5, 4, 3, 3, 2, 2]), 10)) == 3


def test_pack_sizes_fills_bins_with_many_short_items():
    """Six and more items a bin: no filling of up to four items comes near a full bin."""
    rnd = random.Random(8)
    for low, high, n in ((50, 150, 1500), (140, 150, 700)):
        sizes = Counter(2 * rnd.randint(low, high) for _ in range(n))
        bins, bound = pack_sizes(sizes, 2048), -(-sum(s * k for s, k in sizes.items()) // 2048)
        assert len(bins) == bound < len(best_fit(sizes, 2048))
        assert Counter(s for b in bins for s in b) == sizes and all(sum(b) <= 2048 for b in bins)


def test_fillings_are_all_the_undominated():
    rnd = random.Random(9)
    for _ in range(60):
        counts, room = Counter(rnd.randint(1, 12) for _ in range(9)), rnd.randint(1, 24)
        free, spare = Sizes(counts, 24), rnd.randint(0, room)
        want = set()
        for pick in itertools.product(*[range(n + 1) for n in counts.values()]):
            left = Counter({s: n - m for (s, n), m in zip(counts.items(), pick) if n > m})
            items = [s for s, m in zip(counts, pick) for _ in range(m)]
            waste = room - sum(items)
            gives = [0, *items, *[a + b for a, b in itertools.combinations(items, 2)]]
            if 0 <= waste <= spare and not any(x + (k < 1 + len(items)) <= s <= x + waste for k, x in enumerate(gives) for s in left):
                want.add(tuple(sorted(items, reverse=True)))
        got = [tuple(sorted(f, reverse=True)) for f in Fillings(free, room).undominated(spare) if f is not None]
        assert len(got) == len(set(got)) and set(got) == want
        assert [sum(f) for f in got] == sorted(map(sum, got), reverse=True)


def test_pack_documents(spark, tokenizer):
    rnd = random.Random(5)
    docs = [(k, " ".join(rnd.choices(["alpha", "beta", "of", "x1"], k=rnd.randint(0, 500)))) for k in range(150)]
    docs += [(900 + k, t) for k, t in enumerate(ODD)] + [(950, "many words " * 4000), (960, "twin"), (960, "twin"), (None, "n")]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, length int").repartition(4)
    cap = 256
    got = pack_documents(df, public_path(), cap, 0, keep_ids=True)
    rows = got.collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append(r)
    copies = Counter(i for i, _ in docs)
    for i, t in dict(docs).items():
        ids = encoded(tokenizer, t, 0)
        n = -(-len(ids) // cap)
        pieces = sorted(whole[i], key=lambda r: r["piece"])[:: copies[i]]
        assert len(whole[i]) == n * copies[i] and [p["piece"] for p in pieces] == list(range(n))
        at = 0
        for k, p in enumerate(pieces):
            assert (p["start"], p["ids_crc32"]) == (at, crc(ids[at: at + p["length"]])) and (k == 0 or p["length"] == cap)
            at += p["length"]
        assert at == len(ids)
    seq = defaultdict(list)
    for r in rows:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= cap
    total = sum(r["length"] for r in rows)
    assert len(seq) <= -(-total // cap) + 1
    made = sequences(got).collect()
    assert sum(r["n_tokens"] for r in made) == total and all(len(r["ids"]) == 4 * r["n_tokens"] for r in made)


def test_pack_pieces_refuses_wrong_lengths(spark):
    for bad in (0, 11, None):
        with pytest.raises(Exception, match="between 1 and 10"):
            pack_pieces(spark.createDataFrame([(1, bad)], "k int, length long"), 10).collect()
    assert pack_pieces(spark.createDataFrame([], "k int, length long"), 10).collect() == []
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), public_path()).collect() == []
    alike = spark.createDataFrame([(1, 3, "a")] * 40, "k int, length long, offset string")
    got = pack_pieces(alike, 10).collect()
    assert len(got) == 40 and len({r["sequence_id"] for r in got}) == 14


# ---- mixing

def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        of = sum(w[s] for s in names if s not in full)
        out = {s: epochs * sizes[s] if s in full else rest * w[s] / of for s in names}
        over = {s for s in names if s not in full and out[s] > epochs * sizes[s]}
        if not over:
            return out
        full |= over


def test_mixing_meets_targets(spark):
    rnd = random.Random(6)
    names = ["b", "a", "Z", "ä", None, "\U0001F600", "￿"]
    docs = [(k, " ".join(["w"] * int(rnd.expovariate(1 / 60))), names[min(int(rnd.expovariate(0.8)), 6)]) for k in range(1500)]
    docs += [(5000 + k, t, "b") for k, t in enumerate(ODD)]
    df = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, source string, taken int, target double").repartition(4)
    got = {r["doc_id"]: r for r in mix_sources(df).collect()}
    assert len(got) == len(docs)
    sizes = defaultdict(int)
    for i, t, s in docs:
        assert got[i]["size"] == len(words(t))
        sizes[s] += len(words(t))
    targets, taken = brute_targets(sizes), defaultdict(int)
    for i, t, s in docs:
        r = got[i]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 3 + 0.01 * targets[s]
        # whole epochs come first: with a target of at least its size every document is taken
        if targets[s] >= sizes[s]:
            assert all(got[i]["taken"] >= got[i]["size"] for i, _, x in docs if x == s)
    again = {r["doc_id"]: r["taken"] for r in mix_sources(df.repartition(7)).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}


def test_heavier_documents_are_taken_more_often(spark):
    from pyspark.sql import functions as F
    df = spark.range(4000).selectExpr("id as doc_id", "'one two' as text", "'s' as source", "case when id % 2 = 0 then 4.0 else 1.0 end as q")
    got = mix_sources(df, (1,), total_share=0.3, weight=F.col("q"), carry=["q"]).groupBy("row_q").agg({"taken": "sum"}).collect()
    share = {r[0]: r[1] / 4000 for r in got}
    assert share[4.0] > 2.5 * share[1.0] and share[4.0] + share[1.0] == pytest.approx(0.6, abs=0.01)


def test_mixing_small_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    one = mix_sources(spark.createDataFrame([(None, None, None)], schema)).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in one] == [(0, 0, 0.0)]
    twins = mix_sources(spark.createDataFrame([(1, "a b", "s")] * 10, schema)).collect()
    assert sum(r["taken"] for r in twins) == 30


# ---- top-k

def brute_top(rows, k, least=20):
    import math
    good = [(n, i, [math.floor(64 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, u in good:
        if q % least == 0:
            found = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(u, v)))), i)
                           for m, i, v in good if m != n and len(v) == len(u))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("shape", ["spread", "clusters", "copies", "large", "giants"])
def test_top_k_matches_brute_force(spark, monkeypatch, shape):
    from quarry.llm import topk
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 90)
    rnd = np.random.default_rng(7)
    n = 400
    v = rnd.normal(size=(n, 6))
    if shape == "clusters":
        v = rnd.normal(size=(8, 6))[rnd.integers(0, 8, n)] * 5 + v * 0.05
    elif shape == "copies":
        v[: n // 2] = v[0]
    elif shape == "large":
        v *= 1e7
    elif shape == "giants":
        v[::7] *= 1e16
        v[::35] *= 1e20
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(1000, None), (1020, []), (1040, [1.0, None] * 3), (1060, [float("nan")] * 6), (1080, [float("inf")] * 6), (None, [1.0] * 6),
             (1100, [1.0] * 3), (1101, [2.0] * 3), (1120, [0.0] * 6), (20, rows[20][1]), (40, rows[60][1]), (1140, [1e16] + [0.0] * 5), (1141, [3e38] * 6)]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    got = exact_top_k(df, lambda i: i % 20 == 0, k=5).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, 5)


def test_top_k_sends_each_group_what_its_bounds_need(spark, monkeypatch):
    """Far clusters: a cluster's queries are not compared with the others' data."""
    from quarry.llm import topk
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    rnd = np.random.default_rng(3)
    v = np.eye(8)[np.arange(4000) % 8] * 100 + rnd.normal(size=(4000, 8))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    vectors = topk.written(topk.scaled_vectors(df), "vectors")
    got = topk._search(vectors, 5, topk.F.col("vec_id") % 20 == 0, 1024).groupBy("query_id").count().collect()
    # a unit gives a query 5 rows at most: each query is in one unit
    assert len(got) == 200 and {r["count"] for r in got} == {5}


def test_top_k_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert exact_top_k(spark.createDataFrame([], schema), lambda i: i % 20 == 0).collect() == []
    two = exact_top_k(spark.createDataFrame([(0, [1.0, 2.0]), (7, [0.5, 0.0])], schema), lambda i: i % 20 == 0, k=20).collect()
    assert [tuple(r) for r in two] == [(0, 1, 7, 64 * 32)]


# ---- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from quarry.llm.common import written
    from tests.llm.brute import components
    from tests.llm.test_text_operators import brute_lines

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got, kept = [], docs
    for name, stage in cp.STAGES:
        kept = written(stage(spark, kept, "/root/testdata/sf0.001"), "test-stage")
        got.append({} if name == cp.STAGES[-1][0] else [r.asDict() for r in kept.collect()])
        if name != cp.STAGES[-1][0]:
            assert kept.columns == docs.columns
    quality, lines, joined, mixed, _ = got
    assert 150 < len(quality) < 200
    want = brute_lines([(r["doc_id"], r["text"]) for r in quality], 10)
    assert {r["doc_id"]: r["text"] for r in lines} == {i: t for i, (t, *_) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    parts = components([(r["doc_id"], r["text"]) for r in lines])
    assert {r["doc_id"] for r in joined} == {i for i, (_, c) in parts.items() if i == c}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in joined:
        sizes[r["source"]] += len(words(r["text"]))
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    targets = brute_targets(sizes)
    assert set(Counter(r["doc_id"] for r in mixed).values()) <= {1, 2}
    assert sum(abs(taken[s] - targets[s]) for s in sizes) <= 0.05 * sum(targets.values())
    pieces = kept.collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in mixed}
    assert len({r["sequence_id"] for r in pieces}) <= -(-sum(r["length"] for r in pieces) // 2048) + 1
