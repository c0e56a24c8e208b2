"""Document fingerprints: I-Match over several random subsets of a lexicon.

The lexicon is the terms within a band of document frequency. Each fingerprint
part belongs to one random subset of the lexicon: a document's distinct
lexicon terms are sorted, those in the subset are hashed in order, and two
documents agree in the part if they have the same terms of that subset.
Subsets come in several sizes, so that long and short documents both have
parts with one or two terms; among these, agreement estimates the share of
terms that two documents have in common.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import binary_texts, by_bytes, mix64, shuffle_partitions, unzipped, words_of, zipped

#: Subset l of a draw keeps each lexicon term with probability 2**-l, from l = 1
#: to the first that keeps none of the text's terms, and to LEAST_LEVELS at least.
LEAST_LEVELS = 10
DRAWS = 12
#: Terms of a part that still count when likeness is estimated.
SPARSE = 2
#: Fewer lexicon terms than this, and all terms of a text are used.
FEW_TERMS = 8
_PART = 5  # characters: number of terms (hex digit), 16 bits of hash
_DIGIT = np.zeros(256, np.int64)
_DIGIT[np.frombuffer(b"0123456789abcdef", np.uint8)] = np.arange(16)
_PLACE = 16 ** np.arange(_PART - 1, -1, -1)


def term_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): in how many rows each term is. Partial counts leave the
    Python workers, at most a few hundred thousand terms held at a time."""
    def count(batches):
        import pyarrow as pa

        held: Counter = Counter()

        def out():
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([held[k] for k in keys], pa.int64())], ["term", "n"])

        for b in batches:
            for t in binary_texts(b.column(0)):
                held.update(set(words_of(t)))
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(F.col(text_col)).mapInArrow(count, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(docs: DataFrame, least_share: float = 0.001, most_share: float = 0.1, text_col: str = "text") -> list[bytes]:
    """Terms in at least ``least_share`` and at most ``most_share`` of the
    documents (and in more than one), sorted. Their number is bounded whatever the size of the
    corpus: terms with a share s of the documents number at most the mean
    count of distinct terms a document, divided by s."""
    n = docs.count()
    df = term_frequencies(docs, text_col).where((F.col("df") >= max(2, least_share * n)) & (F.col("df") <= max(2, most_share * n)))
    return sorted(bytes(r[0]) for r in df.select("term").toLocalIterator())


class Fingerprinter:
    """Fingerprints of texts by a lexicon and a seed."""

    def __init__(self, terms: list[bytes], seed: int):
        self.seed = seed
        self.place = {t: k for k, t in enumerate(terms)}
        self.depth, self.hash = self._draw(terms)

    def _draw(self, terms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each term: the smallest subset of each draw that it is in, and its hash."""
        base = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little") for t in terms], np.uint64)
        draws = mix64(base[:, None] ^ mix64(np.arange(DRAWS, dtype=np.uint64) + np.uint64(self.seed * DRAWS + 1))[None, :])
        low = draws & (~draws + np.uint64(1))
        return np.log2(np.maximum(low, np.uint64(1)).astype(float)).astype(np.int8), mix64(base + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)

    def of(self, text: bytes) -> str:
        """The fingerprint: for each level and draw the number of terms and 16
        bits of the hash of the sorted terms. It has as many levels as any of
        the terms reaches, so that a text of any length has parts with few
        terms; levels that it lacks are empty."""
        distinct = set(words_of(text))
        known = sorted([self.place[t] for t in distinct if t in self.place])
        if len(known) >= FEW_TERMS:
            depth, hashes = self.depth[known], self.hash[known]
        else:
            depth, hashes = self._draw(sorted(distinct))
        levels = max(LEAST_LEVELS, int(depth.max(initial=0)))
        at, draw = np.nonzero(depth >= 1)
        # by the smallest subset a term is in; what is in a smaller one is in all larger ones of the draw
        cell = (depth[at, draw].astype(np.int64) - 1) * DRAWS + draw
        shape = (levels, DRAWS)
        n = np.bincount(cell, minlength=levels * DRAWS).reshape(shape)
        # terms are sorted and distinct, so a sum of their hashes stands for the list; doubles hold it exactly
        h = np.bincount(cell, weights=hashes[at], minlength=levels * DRAWS).reshape(shape).astype(np.uint64)
        n, h = np.cumsum(n[::-1], axis=0)[::-1], np.cumsum(h[::-1], axis=0)[::-1] & np.uint64(0xFFFFFFFF)
        packed = (np.minimum(n, 15).astype(np.uint32) << 16) | (mix64(h).astype(np.uint32) & np.uint32(0xFFFF)) * (n > 0)
        return "".join([f"{x:05x}" for x in packed.ravel().tolist()])


def likeness(a: str, b: str) -> float:
    """0 to 1: among parts in which either has a term and neither more than
    ``SPARSE``, the share that agree; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    size = max(len(a), len(b))
    x, y = _parts(a.ljust(size, "0")), _parts(b.ljust(size, "0"))  # levels that one lacks are empty there
    most = np.maximum(x >> 16, y >> 16)
    used = (most > 0) & (most <= SPARSE)
    return float((x[used] == y[used]).mean()) if used.any() else 0.0


def _parts(fingerprint: str) -> np.ndarray:
    """The parts of a fingerprint as numbers, ``_PART`` hex digits each."""
    digit = _DIGIT[np.frombuffer(fingerprint.encode(), np.uint8)].reshape(-1, _PART)
    return digit @ _PLACE


def fingerprint(docs: DataFrame, terms: list[bytes], seed: int = 1, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``. A null text is empty; texts
    without terms all have the fingerprint of the empty text. Equal texts have
    equal fingerprints. Rows stay where they are: nothing is shuffled."""
    docs = docs.drop("fingerprint")
    at, fp = docs.columns.index(text_col), Fingerprinter(terms, seed)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = pa.array([fp.of(t) for t in binary_texts(b.column(at))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, "fingerprint"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.StringType())]))


def in_descending_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_p, _extra, _id, _hash, _text, _text_n), texts ``zipped``: partition p holds a range of ids,
    sorted descending, and after them (``_extra``) a copy of the document that
    follows: the first of the next lower range, or for the lowest range the
    first of all. So every document and its next stand together. Null ids come
    last, equal ids in the order of their texts' hashes.

    Bounds come from a quantile sketch of the ids, then the largest id of each
    range is exact: the driver sees one number a partition, and the text is
    shuffled once.
    """
    spark, n = docs.sparkSession, shuffle_partitions(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    cuts = src.select("_id").agg(F.percentile_approx("_id", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("int")
    def place(ids):
        return ids.__class__(np.where(ids.isna(), 0, np.searchsorted(cuts, ids.fillna(0).astype("int64"), side="left")).astype("int32"))

    def placed(df: DataFrame) -> DataFrame:
        # ids pass as nullable numbers: a long is exact in a double only up to 2**53, so nulls are told apart first
        return df.withColumn("_p", F.when(F.col("_id").isNull(), F.lit(0)).otherwise(place(F.coalesce("_id", F.lit(0).cast("long")))))

    tops = placed(src.select("_id")).groupBy("_p").agg(F.max("_id").alias("top"), F.count(F.lit(1)).alias("n")).orderBy("_p").collect()
    lead = [(r["top"], tops[k + 1]["_p"] if k + 1 < len(tops) else tops[0]["_p"], k + 1 == len(tops)) for k, r in enumerate(tops)]
    leads = spark.createDataFrame(lead, "_top bigint, _to int, _wrap boolean")  # a row a partition
    src = src.withColumn("_hash", F.xxhash64("_text"))
    copies = src.join(F.broadcast(leads), F.col("_id").eqNullSafe(F.col("_top"))) \
        .select(F.col("_to").alias("_p"), F.lit(True).alias("_extra"), "_id", "_hash", "_text")
    own = placed(src).select("_p", F.lit(False).alias("_extra"), "_id", "_hash", "_text")
    return zipped(own.unionByName(copies), "_text").repartitionById(max(1, len(cuts) + 1), F.col("_p")) \
        .sortWithinPartitions("_extra", F.col("_id").desc_nulls_last(), "_hash")


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of another text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def compare_with_next(docs: DataFrame, terms: list[bytes], seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): each document against its edited text
    (``edited_text`` with the next document, descending id; after the last the
    first) and against the next document. A single document is its own next.
    Ids are integers; null ids and texts as in ``in_descending_order``.
    Repeated rows are documents of their own."""
    fp = Fingerprinter(terms, seed)

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        last, closed = None, False
        for b in batches:
            rows = zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("_id", "_text", "_extra", "_text_n")])
            for part in by_bytes(rows, lambda r: r[3], 1 << 22):
                out: list[list] = [[] for _ in kinds]
                for i, raw, extra, n in part:
                    if closed:
                        break
                    text = unzipped(raw, n).decode()
                    own = fp.of(text.encode())
                    if last is not None:
                        j, before, its = last
                        new = edited_text(before, text)
                        new_fp = fp.of(new.encode())
                        for c, v in zip(out, (j, len(before), hashlib.sha256(new.encode()).hexdigest(), its, new_fp,
                                              likeness(its, new_fp), likeness(its, own))):
                            c.append(v)
                    last, closed = (i, text, own), extra
                if out[0] or out[1]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    out = in_descending_order(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("doc_id", id_col)
