"""Line dedup, license scan, quality, fingerprints, Jaccard join against brute force and on awkward rows."""

import hashlib
import random
import re
from collections import Counter

import pytest

from quarry.llm import fingerprints as fp
from quarry.llm import jaccard, quality
from quarry.llm.license_texts import TEXTS
from quarry.llm.licenses import NOTICES, STEP, WINDOW, all_templates, bands_for, notices, scan_licenses
from quarry.llm.lines import dedup_lines
from tests.llm.brute import LOWER, ODD, components

DOCS = "doc_id long, text string"


def table(spark, rows, schema=DOCS, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{int(vocabulary * rnd.random() ** 2)}" for _ in range(n))


# ---- lines

def brute_lines(docs, least):
    strip = lambda line: line.translate(LOWER).strip(" \t\n\x0b\x0c\r")
    found = Counter(k for _, t in docs for k in {strip(x) for x in (t or "").split("\n")} if k)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (strip(x) and found[strip(x)] >= least)]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def test_line_dedup_matches_brute_force(spark):
    rnd = random.Random(1)
    pool = ["Common line", " common LINE\t", "É", "é", "x", "", "  ", "only 1"] + [f"l{k}" for k in range(30)]
    docs = [(k, "\n".join(rnd.choices(pool, k=rnd.randint(1, 12)))) for k in range(60)]
    docs += [(100 + k, t) for k, t in enumerate(ODD)] + [(200, "common line\n" * 30_000 + "end")]
    df = table(spark, [(i, t, "a", 5) for i, t in docs], "doc_id long, text string, _key string, n_lines int")
    got = dedup_lines(df, min_docs=4).collect()
    want = brute_lines(docs, 4)
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got} == want
    assert {r["_key"] for r in got} == {"a"} and len(got) == len(docs)


def test_line_dedup_counts_rows_and_keeps_null_ids(spark):
    got = dedup_lines(table(spark, [(None, "a\nb"), (None, "a\nc"), (1, "a\nd"), (1, "a\nd")]), min_docs=4).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, "b"), (0, "c"), (1, "d"), (1, "d")]
    assert dedup_lines(table(spark, [])).collect() == []


# ---- licenses

def test_license_scan_finds_planted_notices_only(spark):
    rnd = random.Random(2)
    docs, want = [], {}
    for k in range(80):
        body = prose(rnd, rnd.randint(0, 60)).split()
        if k % 2:
            name = rnd.choice(sorted(NOTICES))
            at = rnd.randint(0, len(body))
            body[at:at] = NOTICES[name].upper().split()
            want[k] = (name, at)
        docs.append((k, " ".join(body)))
    docs += [(100 + k, t) for k, t in enumerate(ODD)]
    df = table(spark, [(i, t, 1) for i, t in docs], "doc_id long, text string, template int")
    got = scan_licenses(df, notices(spark)).collect()
    found = {(r["doc_id"], r["template"]): r for r in got}
    for k, (name, at) in want.items():
        r = found[k, name]
        assert (r["containment"], r["start"]) == (1.0, at)
    # the short Apache notice is part of its header
    assert {d for d, _ in found} == set(want)
    assert all(r["template"] == want[r["doc_id"]][0] or "apache" in r["template"] for r in got)


def test_license_scan_takes_edited_notices_at_the_threshold(spark):
    words = [f"t{k}" for k in range(32)]
    templates = spark.createDataFrame([("long", " ".join(words)), ("none", None), ("blank", " ")], "template string, text string")
    near, far = words.copy(), words.copy()
    near[10] = "other"  # 3 of 30 shingles
    for k in (5, 10, 15):
        far[k] = "other"  # 9 of 30
    got = scan_licenses(table(spark, [(1, " ".join(near)), (2, " ".join(far)), (1, " ".join(near))]), templates).collect()
    assert [(r["doc_id"], r["template"], r["containment"]) for r in got] == [(1, "long", 0.9)]
    assert (1 - 1 / 4) ** bands_for(0.005) <= 0.005
    assert scan_licenses(table(spark, []), templates).collect() == []
    with pytest.raises(ValueError):
        scan_licenses(table(spark, []), templates, max_template_words=10)


def brute_licenses(docs, templates, least):
    def shingles(text):
        w = [x for x in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if x]
        return [tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else [], len(w)

    out = {}
    for i, text in docs:
        have, _ = shingles(text)
        for name, template in templates:
            want, n = shingles(template)
            want, best = set(want), None
            for start in range(0, len(have), STEP):
                if not set(have[start:start + WINDOW - 2]) & want:
                    continue
                first = max(0, start - n)
                around = have[first:first + 2 * n + WINDOW]
                share = len(want.intersection(around)) / len(want)
                at = first + next(k for k, x in enumerate(around) if x in want)
                if share >= least and (best is None or (share, -at) > best):
                    best = share, -at
            if best:
                out[i, name] = (n, -best[1], best[0])
    return out


def test_license_scan_matches_brute_force(spark):
    rnd = random.Random(12)
    templates = [(f"t{k}", prose(rnd, n)) for k, n in enumerate([3, 4, 7, 12, 30, 90, 400, 3000])]
    docs = []
    for k in range(60):
        body = prose(rnd, rnd.randint(0, 80)).split()
        for _ in range(rnd.randint(0, 3)):
            words = rnd.choice(templates)[1].split()
            for _ in range(rnd.randint(0, len(words) // 25)):
                words[rnd.randrange(len(words))] = rnd.choice(["new", "other, ", "w1"])
            at = rnd.randint(0, len(body))
            body[at:at] = words
        docs.append((k, " ".join(body)))
    want = brute_licenses(docs, templates, 0.8)
    got = scan_licenses(table(spark, docs + docs[:5]), spark.createDataFrame(templates, "template string, text string")).collect()
    assert {(r["doc_id"], r["template"]): (r["n_words"], r["start"], r["containment"]) for r in got} == want
    assert len(got) == len(want) > 40 and {t for _, t in want} == {t for t, _ in templates}


def test_license_scan_finds_whole_texts_in_very_long_ones(spark):
    rnd = random.Random(13)
    body = prose(rnd, 200_000, 5000)
    docs = [(k, "Copyright someone\n\n" + t.replace("\n", "\n// ").replace("any", "some", 1)) for k, t in enumerate(TEXTS.values())]
    docs += [(50, body), (51, body + " " + TEXTS["mit-text"]), (None, TEXTS["isc-text"]), (None, TEXTS["isc-text"]), (None, None)]
    got = scan_licenses(table(spark, docs), all_templates(spark)).collect()
    found = {(r["doc_id"], r["template"]): r["start"] for r in got}
    assert all((k, name) in found for k, name in enumerate(TEXTS)) and (None, "isc-text") in found
    assert 50 not in {i for i, _ in found} and found[51, "mit-text"] == found[51, "mit-grant"] == 200_000
    assert len(got) == len(found)


# ---- quality

def test_weak_labels_learn_to_tell_junk(spark):
    rnd = random.Random(3)
    rows, truth = [], {}
    for k in range(600):
        t = ". ".join(prose(rnd, rnd.randint(5, 12), 3000).capitalize() for _ in range(rnd.randint(3, 9))) + "."
        bad = k % 5 == 0
        if bad:
            t = rnd.choice([lambda: t.upper().replace(" ", "!! "), lambda: t.replace(" ", "&&& "), lambda: t.replace(" ", " | "),
                            lambda: "loop " * 80])()
        truth[k] = not bad
        rows.append((k, t, 7))
    df = table(spark, rows + [(1000 + k, t, 7) for k, t in enumerate(ODD)] + [(None, "a b", 7)], "doc_id long, text string, keep int")
    got = quality.score_quality(df).collect()
    assert len(got) == len(rows) + len(ODD) + 1 and got[0].__fields__ == ["doc_id", "text", "quality", "weak_quality", "keep"]
    keep = {r["doc_id"]: r["keep"] for r in got}
    assert sum(keep[k] == truth[k] for k in truth) >= 0.98 * len(truth)
    again = {r["doc_id"]: r["quality"] for r in quality.score_quality(df.repartition(5)).collect()}
    assert again == pytest.approx({r["doc_id"]: r["quality"] for r in got})
    assert quality.score_quality(table(spark, [])).collect() == []


def test_quality_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet")).join(
        spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "quality as label"), "doc_id").collect()
    good, bad = [r["keep"] for r in got if r["label"]], [r["keep"] for r in got if not r["label"]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_sample_is_of_different_rows(spark, monkeypatch):
    rnd = random.Random(9)
    docs = [(k, prose(rnd, 60, 900)) for k in range(300)]
    df = table(spark, docs + [docs[0]] * 3000)
    sizes, fit = [], quality.fit_scorer
    monkeypatch.setattr(quality, "fit_scorer", lambda rows: sizes.append(len(rows)) or fit(rows))
    got = {(r["doc_id"], r["quality"]) for r in quality.score_quality(df, sample_rows=100).collect()}
    assert len(got) == 300 and 50 < sizes[0] <= 200


# ---- fingerprints

def test_fingerprints_tell_edits_from_others(spark):
    rnd = random.Random(4)
    docs = [(k, prose(rnd, 150, 5000)) for k in range(120)] + [(500 + k, t) for k, t in enumerate(ODD)] + [(700, docs_copy := "same text " * 9), (701, docs_copy)]
    df = table(spark, [(i, t, "z") for i, t in docs], "doc_id long, text string, fingerprint string", 5)
    terms = fp.lexicon(df)
    got = {r["doc_id"]: r for r in fp.compare_with_next(df, terms).collect()}
    order = sorted(docs, reverse=True, key=lambda r: r[0])
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        new = t[: len(t) - n] + following[:n]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    long = [got[k] for k in range(1, 120)]
    assert sum(r["near_edited"] > r["near_next"] + 0.1 for r in long) >= 0.95 * len(long)
    assert got[700]["fingerprint"] == got[701]["fingerprint"] and got[701]["near_next"] == 1.0
    own = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprint(df, terms).collect()}
    assert own == {i: r["fingerprint"] for i, r in got.items()}


@pytest.mark.parametrize("known", [True, False])
@pytest.mark.parametrize("size", [3, 50, 5_000, 20_000, 100_000])
def test_likeness_of_texts_of_any_length(size, known):
    """Edited copies are told from other texts, by lexicon terms or, where a text has too few, by all its terms."""
    import numpy as np

    off = []
    for seed in range(1, 6):
        terms = [f"t{k}".encode() for k in range(2 * size)]
        printer = fp.Fingerprinter(terms if known else [b"other"], seed)
        text, edited, other = terms[:size], terms[size // 10: size + size // 10], terms[size:]
        a, b, c = (printer.of(b" ".join(t)) for t in (text, edited, other))
        assert fp.likeness(a, a) == 1.0
        if size > 10:
            off += [fp.likeness(a, b) - 0.8]
            assert fp.likeness(a, b) == fp.likeness(b, a) > 0.35 and fp.likeness(a, c) < 0.2
            parts = fp._parts(a) >> 16
            assert ((parts > 0) & (parts <= fp.SPARSE)).sum() >= fp.DRAWS / 2
    assert not off or abs(np.mean(off)) < 0.15


def test_fingerprints_of_few_rows(spark):
    assert fp.compare_with_next(table(spark, []), fp.lexicon(table(spark, []))).collect() == []
    one = table(spark, [(None, "abc def ghi")])
    r = fp.compare_with_next(one, fp.lexicon(one)).collect()
    assert len(r) == 1 and r[0]["doc_id"] is None and r[0]["near_next"] == 1.0
    twins = table(spark, [(1, "a b c"), (1, "a b c"), (None, "x")])
    assert len(fp.compare_with_next(twins, fp.lexicon(twins)).collect()) == 3


def test_lexicon_is_the_band(spark):
    df = table(spark, [(k, " ".join(["all"] + [f"t{k % 10}"] + [f"once{k}"])) for k in range(100)])
    assert fp.lexicon(df, 0.05, 0.5) == sorted(f"t{k}".encode() for k in range(10))


# ---- Jaccard join

def near_groups(rnd):
    docs = []
    for _ in range(25):
        base = prose(rnd, rnd.choice([3, 6, 12, 40, 150, 400]), 50_000).split()
        for _ in range(rnd.randint(1, 7)):
            t = base.copy()
            for _ in range(rnd.randint(0, max(1, len(t) // 30))):
                t[rnd.randrange(len(t))] = f"e{rnd.random()}"
            docs.append(" ".join(t + [f"x{rnd.random()}"] * rnd.randint(0, len(t) // 20)))
    passage = prose(rnd, 70, 50_000)  # shared by many that are not alike
    docs += [prose(rnd, 60, 50_000) + " " + passage + " " + prose(rnd, 60, 50_000) for _ in range(20)]
    docs += [passage + " " + prose(rnd, rnd.randint(8, 30), 50_000) for _ in range(30)]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    docs = near_groups(rnd)
    docs += [(1000 + k, t) for k, t in enumerate(ODD)] + [(2000, "A b C d"), (2001, "a B c D "), (2002, "q " * 40_000)]
    want = components(docs)
    df = table(spark, [(i, t, 1, "s") for i, t in docs], "doc_id long, text string, id int, sig string")
    got = jaccard.jaccard_components(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(docs)


def test_signatures_guarantee(monkeypatch):
    """Sets of likeness 0.8 share a signature in a common band, with fewer differing than the budget."""
    rnd = random.Random(6)
    for size in [5, 20, 63, 64, 70, 190, 192, 300, 575, 600, 1500]:
        for _ in range(20):
            both = [rnd.getrandbits(63) for _ in range(size)]
            cut = size // 5
            other = both[cut:] if rnd.random() < 0.5 else both + [rnd.getrandbits(63) for _ in range(size // 4)]
            import numpy as np
            a, b = (set(jaccard.signatures(np.unique(np.array(x, np.uint64))).tolist()) for x in (both, other))
            assert {x >> 1 for x in a} & {x >> 1 for x in b}


def test_jaccard_repeated_null_and_empty(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), None: (2, None)}
    assert jaccard.jaccard_components(table(spark, [])).collect() == []


def test_maybe_in_keeps_every_key_and_drops_most_others(spark):
    """Wide rows are dropped before the shuffle of a semi join."""
    from pyspark.sql import functions as F

    from quarry.llm.common import maybe_in

    rows = spark.range(-20000, 60000).select("id", F.col("id").cast("string").alias("text")) \
        .unionByName(spark.createDataFrame([(None, "x"), (7, "again")], "id long, text string"))
    keys = spark.range(0, 60000, 7).unionByName(spark.createDataFrame([(None,), (-(1 << 62),)], "id long"))
    got = maybe_in(rows, "id", keys)
    assert got.columns == ["id", "text"]
    assert got.join(keys, "id", "left_semi").count() == rows.join(keys, "id", "left_semi").count() == 8573
    assert got.count() < 8573 + 0.1 * 80000
    assert maybe_in(rows, "id", keys.where("false")).collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_jaccard_ids_with_several_texts(spark):
    """An id links through any of its texts, also if one is much longer than the copied one."""
    rnd = random.Random(21)
    short, long, other = prose(rnd, 104, 5000), prose(rnd, 1500, 5000), prose(rnd, 300, 5000)
    near = lambda t: t + " end"
    rows = [(11, short), (2, near(short)), (2, long), (13, near(long)), (4, other), (5, prose(rnd, 200, 5000)), (5, prose(rnd, 90, 5000)),
            (7, near(other)), (7, near(other)), (6, " "), (6, short + " x")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(table(spark, rows)).collect()}
    assert got == {11: 2, 2: 2, 13: 2, 6: 2, 4: 4, 7: 4, 5: 5}


def test_forget_drops_what_other_operators_left(spark):
    """A tokenizer and its words stayed in workers that went on to other operators."""
    from quarry.llm.common import forget, worker_cache
    from quarry.llm.encoding import encoder, public_path

    encoder(public_path()).encode(["some words of a text"])
    forget()
    assert not [k for k in worker_cache() if k.startswith("encoder:")]
    from quarry.llm.jaccard import jaccard_components

    docs = spark.createDataFrame([(k, f"w{k % 40} a b c d e") for k in range(1300)], "doc_id long, text string").coalesce(1)
    assert jaccard_components(docs).agg({"component_id": "max"}).first()[0] == 39  # over several slices of a batch
