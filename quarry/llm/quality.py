"""Quality classifier from weak labels.

Heuristic labellers, each for a sign of junk, vote junk or nothing on every document; one votes good on plain prose.
Expectation-maximisation over the counts of their vote patterns estimates how
often each is right, without any hand-made label. The posterior of a
document's pattern is the target that a linear scorer over hashed text
features is trained on; the scorer decides.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import binary_texts, forget, written

JUNK, GOOD, NONE = 1, 0, -1
LABELLERS = ("capitals", "symbols", "separators", "stutter", "variety", "doubled", "prose")
#: Hashed features; the scorer has a weight for each.
DIMS = 1 << 14

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DOUBLED = re.compile(rb"([!-/:-@\[-`{-~])\1")
_PLAIN = _LETTERS + b"0123456789 \t\n\x0b\x0c\r.,;:'\"()-?"
#: Letters to a or A, digits to 0; the rest stays.
_SHAPE = bytes.maketrans(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)) + b"0123456789",
                         b"A" * 26 + b"a" * 26 + b"a" * 128 + b"0" * 10)


def measures(text: bytes) -> tuple[list[bytes], dict[str, float]]:
    """The words of a text and the shares that the labellers look at."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    letters = size - len(text.translate(None, _LETTERS)) if text else 0
    return words, {
        "words": len(words),
        "capitals": (len(text) - len(text.translate(None, _UPPER))) / max(1, letters),
        "symbols": len(text.translate(None, _PLAIN)) / size,
        "separators": (text.count(b"|") + text.count(b">") + text.count(b"\xc2\xbb")) / n,
        "stutter": sum(map(operator.eq, words, words[1:])) / n,
        # the share of new words falls with length; its expected fall is taken out
        "variety": len(set(words)) / n + 0.05 * np.log2(n),
        "doubled": len(_DOUBLED.findall(text)) / n,
        "stops": (text.count(b". ") + text.count(b".\n") + text.count(b", ") + text.endswith(b".")) / n,
    }


def votes(m: dict[str, float]) -> list[int]:
    """A vote of each labeller. Several overlap: shouting is full of capitals
    and of doubled marks, tables and noise of symbols, loops of stutter and of
    few different words."""
    signs = (m["capitals"] >= 0.5, m["symbols"] >= 0.05, m["separators"] >= 0.15,
             m["words"] >= 20 and m["stutter"] >= 0.15, m["words"] >= 20 and m["variety"] <= 0.7, m["doubled"] >= 0.2)
    prose = (m["words"] < 8 or 0.03 <= m["stops"] <= 0.6) and m["capitals"] <= 0.25 and m["symbols"] <= 0.02 and m["variety"] >= 0.75
    return [JUNK if x else NONE for x in signs] + [GOOD if prose else NONE]


def features(words: list[bytes], text: bytes, m: dict[str, float]) -> tuple[list[int], list[float]]:
    """Hashed features: shares of word shapes (first and last two characters),
    of short words, and the measures in steps."""
    n = max(1, len(words))
    shapes = Counter([w[:1] + w[-2:] for w in text.translate(_SHAPE).split()])
    out: dict[int, float] = {}
    for k, c in shapes.items():
        h = zlib.crc32(b"s" + k) % DIMS
        out[h] = out.get(h, 0.0) + c / n
    for k, x in m.items():
        step = int(np.log2(x + 1)) if k == "words" else min(20, int(x * 20))
        h = zlib.crc32(f"{k}:{step}".encode()) % DIMS
        out[h] = out.get(h, 0.0) + 0.5
    return list(out), list(out.values())


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of junk for each vote pattern (rows of ``patterns``).

    Votes are taken as independent given the class. Each labeller has, for
    each class, a probability of every vote; EM alternates these with the
    posteriors, weighted by how many documents have the pattern.
    """
    if not len(counts):
        return np.zeros(0)
    junk, good = (patterns == JUNK).sum(1), (patterns == GOOD).sum(1)
    post = np.where(junk > 0, np.where(good > 0, 0.5, 0.95), np.where(good > 0, 0.02, 0.2))
    for _ in range(rounds):
        prior = np.clip((post * counts).sum() / counts.sum(), 1e-6, 1 - 1e-6)
        log = np.tile(np.log([1 - prior, prior]), (len(counts), 1))
        for j in range(patterns.shape[1]):
            for c, w in enumerate((counts * (1 - post), counts * post)):
                like = {v: (w[patterns[:, j] == v].sum() + 0.5) / (w.sum() + 1.5) for v in (JUNK, GOOD, NONE)}
                log[:, c] += np.log([like[v] for v in patterns[:, j]])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post


def fit_scorer(rows: list[tuple[list[int], list[float], float]], rounds: int = 15, rate: float = 0.5,
               decay: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic weights and bias by AdaGrad over the rows, in a fixed order."""
    w, b = np.zeros(DIMS), 0.0
    gw, gb = np.full(DIMS, 1e-6), 1e-6
    prepared = [(np.array(i), np.array(x), y) for i, x, y in rows]
    for r in range(rounds):
        for k in np.random.default_rng(r).permutation(len(prepared)):
            i, x, y = prepared[k]
            p = 1 / (1 + np.exp(-np.clip(w[i] @ x + b, -30, 30)))
            g = p - y
            gi = g * x + decay * w[i]
            gw[i] += gi * gi
            gb += g * g
            w[i] -= rate * gi / np.sqrt(gw[i])
            b -= rate * g / np.sqrt(gb)
    return w, b


def score_quality(docs: DataFrame, sample_rows: int = 4000, threshold: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``quality`` (the scorer's probability that
    the text is good), ``weak_quality`` (the posterior of the labellers'
    votes) and ``keep`` (``quality`` at least ``threshold``).

    Every document votes: EM runs on the counts of the vote patterns, of which
    there are 3 to the number of labellers at most. The scorer is fitted on a
    bounded sample, about ``sample_rows`` different pairs of id and text chosen
    by their hash, twice as many at most; every document is scored on its whole text.

    A null or empty text shows no sign of anything: all labellers abstain and
    the scorer decides. Repeated rows are
    scored alike. Columns named as the three outputs are replaced; other
    extra columns stay. An empty table gives an empty result.
    """
    outputs = ("quality", "weak_quality", "keep")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in outputs])
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_labellers = len(LABELLERS)

    def vote(batches):
        import pyarrow as pa

        forget()
        for b in batches:
            v = [votes(measures(t)[1]) for t in binary_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.list_(pa.int8())), b.column(1)], ["v", "h"])

    voted = written(docs.select(text.alias("t"), F.xxhash64(F.col(id_col), text).alias("h"))
                    .mapInArrow(vote, "v array<tinyint>, h bigint"), "votes")
    table = voted.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v").collect()  # 3**labellers rows at most
    patterns = np.array([r["v"] for r in table], dtype=int).reshape(-1, n_labellers)
    counts = np.array([r["n"] for r in table], dtype=float)
    posterior = {tuple(p): float(x) for p, x in zip(patterns.tolist(), estimate(patterns, counts))}

    def encode(batches):
        import pyarrow as pa

        forget()
        for b in batches:
            idx, val, y = [], [], []
            for t in binary_texts(b.column(0)):
                words, m = measures(t)
                i, x = features(words, t, m)
                idx.append(i)
                val.append(x)
                y.append(posterior.get(tuple(votes(m)), 0.5))
            yield pa.RecordBatch.from_arrays([pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64())),
                                              pa.array(y, pa.float64()), b.column(1)], ["i", "x", "y", "h"])

    # repeated rows count once, so one row's copies are neither the sample nor all in the driver
    different = voted.select("h").distinct().count()
    share = min(1.0, sample_rows / max(1, different))
    chosen = docs.select(text.alias("t"), F.xxhash64(F.col(id_col), text).alias("h")) \
                 .where(F.pmod(F.col("h"), F.lit(1_000_003)) < int(share * 1_000_003) + (share == 1.0)) \
                 .groupBy("h").agg(F.min("t").alias("t")).select("t", "h")
    sample = sorted(chosen.mapInArrow(encode, "i array<int>, x array<double>, y double, h bigint").orderBy("h").limit(2 * sample_rows).collect(),
                    key=lambda r: (r["h"], r["y"]))
    weights, bias = fit_scorer([(r["i"], r["x"], r["y"]) for r in sample])

    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("quality", T.DoubleType()),
                           T.StructField("weak_quality", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def score(batches):
        import pyarrow as pa

        forget()
        for b in batches:
            q, weak = [], []
            for t in binary_texts(b.column(at)):
                words, m = measures(t)
                i, x = features(words, t, m)
                z = float(weights[i] @ np.array(x)) + bias
                q.append(1 - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
                weak.append(1 - posterior.get(tuple(votes(m)), 0.5))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(q, pa.float64()), pa.array(weak, pa.float64()),
                 pa.array([x >= threshold for x in q], pa.bool_())], [f.name for f in schema])

    return docs.mapInArrow(score, schema)
