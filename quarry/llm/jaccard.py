"""N-gram Jaccard join by PartEnum signatures.

A document's set is its distinct word shingles. The feature domain is cut into
parts by a hash; a set's signature for a part is the hash of the features it
has there. If two sets differ in k features at most, they differ in k parts at
most, so of more than k parts that a set has features in, one is the same in
both. Sets of likeness 0.8 or more differ in a quarter of either's size at
most, and the number of parts is chosen by size band so that more parts than
that have features. Sets near the end of a band also get the next band's
signatures, so any two that may be linked share a band.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm.common import binary_texts, by_bytes, connected_components, forget, maybe_in, mix64, unzipped, words_of, written, zipped

#: Least likeness of a link, in hundredths.
LIKENESS = 80
#: Bits of a signature; fewer make shuffles smaller and false candidates more.
SIGNATURE_BITS = 48
#: Sets below this size have a part for each feature.
SMALL = 64
#: Sizes of a band rise by this factor.
BAND = 3
#: Of a band's parts, the share that is used: enough for the guarantee at its lower and upper end.
USED = 0.85

#: 64-bit words of a set's parity sketch.
PARITY_WORDS = 16

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x5851F42D4C957F2D)
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if not _powers or len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b)]), dtype=np.uint64) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def shingle_sets(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes: runs of
    ``words`` words, or all words of a shorter text as one; none without words.

    A shingle's hash is a polynomial over its bytes, of which all are had at
    once as differences of one running sum.
    """
    split = [words_of(t) for t in texts]
    out = []
    for w in split:
        if not w:
            out.append(np.zeros(0, np.uint64))
            continue
        joined = np.frombuffer(b" ".join(w), np.uint8)
        up, down = _power(len(joined) + 1)
        run = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(_BYTE[joined] * up[: len(joined)], out=run[1:])
        length = np.fromiter(map(len, w), np.int64, len(w))
        start = np.cumsum(length + 1) - length - 1
        k = min(words, len(w))
        first, last = start[: len(w) - k + 1], (start + length)[k - 1:]
        out.append(np.unique(mix64((run[last] - run[first]) * down[first] + (last - first).astype(np.uint64))))
    return out


def likeness_of(a: np.ndarray, b: np.ndarray) -> float:
    """In hundredths; exact where it is a whole number."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both / max(1, len(a) + len(b) - both)


def _bands(size: int) -> list[int]:
    """Lower ends of the bands that a set of this size has signatures for:
    its own, and the next if a set 100/LIKENESS times its size is there."""
    low = 1
    while low < SMALL and size >= SMALL or size >= max(SMALL, low * BAND) > low:
        low = SMALL if low < SMALL else low * BAND
    upper = SMALL if low < SMALL else low * BAND
    return [low, upper] if size * 100 >= upper * LIKENESS else [low]


def signatures(features: np.ndarray) -> np.ndarray:
    """PartEnum signatures of a set of feature hashes: ``SIGNATURE_BITS`` bits,
    times two, plus 1 for those of the band above the set's own."""
    out = []
    drop = np.uint64(64 - SIGNATURE_BITS)
    for k, low in enumerate(_bands(len(features))):
        k = np.uint64(k)
        tag = mix64(np.array([low], np.uint64))[0]
        if low < SMALL:
            out.append((mix64(features ^ tag) >> drop) * np.uint64(2) + k)
            continue
        # 2.8 features a part at the upper end of the band: 0.33 of a set's size are parts with features, over a quarter
        parts = np.uint64(max(1, round(low * BAND / 2.8)))
        part = (mix64(features) >> np.uint64(20)) % parts
        used = part < np.uint64(int(USED * int(parts)) + 1)
        order = np.argsort(part[used], kind="stable")
        part, feature = part[used][order], features[used][order]
        if not len(part):
            continue
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        whole = np.add.reduceat(mix64(feature ^ tag), starts)
        out.append((mix64(whole ^ mix64(part[starts] ^ tag)) >> drop) * np.uint64(2) + k)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def parities(features: np.ndarray) -> list[int]:
    """``PARITY_WORDS`` times 64 bits; each feature flips one. The bits in which
    two sets differ are features in which they differ, at least as many."""
    bit = mix64(features ^ np.uint64(0x3C6EF372FE94F82B)) % np.uint64(64 * PARITY_WORDS)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _with_sets(docs: DataFrame, words: int, zip_: bool = False) -> DataFrame:
    """(id, n, h, g, sigs) of (id, text) or, with ``zip_``, (id, text, text_n): size and 128-bit hash
    of the set, signatures; with ``zip_`` also its parity sketch ``p``."""
    def run(batches):
        import pyarrow as pa

        forget()
        for b in (batch.slice(lo, 500) for batch in batches for lo in range(0, batch.num_rows, 500)):
            raw = binary_texts(b.column(1))
            rows = zip(b.column(0).to_pylist(), map(unzipped, raw, b.column(2).to_pylist()) if zip_ else raw)
            for part in by_bytes(rows, lambda r: len(r[1]), 1 << 22):
                sets = shingle_sets([t for _, t in part], words)
                cols = [pa.array([i for i, _ in part], b.column(0).type), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(mix64(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64()),
                        pa.array([int((mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))).sum(dtype=np.uint64).astype(np.int64)) for s in sets], pa.int64())]
                got = [signatures(s) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(got), pa.int64())))
                if zip_:
                    cols.append(pa.array([parities(s) for s in sets], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "h", "g", "sigs", "p"][: len(cols)])

    return docs.mapInArrow(run, "id bigint, n bigint, h bigint, g bigint, sigs array<bigint>" + ", p array<bigint>" * zip_)


def _verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, near) for each pair: the exact likeness of their sets. The
    texts are joined to the pairs on either side; a text that is in very many
    pairs is split by AQE's skew join."""
    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"), F.col("text_n").alias("na"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"), F.col("text_n").alias("nb"))

    def run(batches):
        import pyarrow as pa

        held: dict[tuple, np.ndarray] = {}  # sets of the pivots, which come again and again
        for batch in batches:
            b, ta, na, tb, nb = [batch.column(k).to_pylist() for k in range(1, 6)]
            near = []
            for k in range(len(b)):
                key = (b[k], tb[k])
                if key not in held:
                    if len(held) > 64:
                        held.clear()
                    held[key] = shingle_sets([unzipped(tb[k], nb[k])], words)[0]
                near.append(likeness_of(shingle_sets([unzipped(ta[k], na[k])], words)[0], held[key]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.float64())], ["a", "b", "near"])

    both = pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "na", "tb", "nb")
    return both.mapInArrow(run, "a bigint, b bigint, near double")


def jaccard_components(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): size of each document's shingle set and
    the smallest id that it can reach over links. Two documents link if the
    intersection of their sets is at least 80 hundredths of the union.

    Ids are integers. A text that is null or without words has the empty set
    and links with nothing. Rows with the same id are one document, whose
    texts all count: it links through any of them, and ``n_shingles`` is the
    largest of them. A null id keeps a null component. Extra columns are not
    read.

    1. Signatures of all sets are counted. A set whose signatures are its own
       but for a quarter of its size has no link and is done; these are nearly
       all. (A set with the same features as another never is.)
    2. For the others, each set keeps its rarest signatures, as many as its
       features may differ plus one; any two that link share one of these.
    3. Each signature's sets are compared with one of them, the one with the
       fewest signatures of its own, so a bucket of any size costs one
       comparison a row; links give components.
    4. Where a bucket still holds several components, sets of different
       components are compared, all that can be near by their sizes, by the
       triangle inequality of the Jaccard distance to that one set, and by
       parity sketches, which bound from below how much two sets differ.

    Comparisons use whole sets. Only counts, signatures and the texts of the
    few candidate documents are shuffled.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = written(_with_sets(src, words), "sets")

    def exploded(df: DataFrame, *more: str) -> DataFrame:
        """(ref, sig): ref is the id times two, plus the band's place; and the columns ``more``."""
        return df.where("id is not null").select("id", *more, F.explode("sigs").alias("s")) \
            .select((F.col("id") * 2 + F.col("s").bitwiseAND(1)).alias("ref"), F.shiftright("s", 1).alias("sig"), *more)

    # 1. (signature, how many rows, one of them); those of one row are summed by document and band
    seen = exploded(sets).groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.min("ref").alias("ref"))
    own = seen.where("c = 1").groupBy("ref").agg(F.count(F.lit(1)).alias("own"))
    own = own.groupBy(F.shiftright("ref", 1).alias("id")).agg(F.collect_list("own").alias("own"))  # two bands at most
    facts = sets.select("id", "n", "h", "g", F.size(F.array_distinct(F.transform("sigs", lambda s: s.bitwiseAND(1)))).alias("bands")) \
        .where("id is not null and n > 0")
    budget = F.floor(F.col("n") * (100 - LIKENESS) / LIKENESS).cast("long")
    over = F.coalesce(F.size(F.filter("own", lambda x: x > budget)), F.lit(0))
    # signatures are summed by id, so nothing is known of the sets of an id that has several
    whole = F.struct("n", "h", "g")
    many = facts.groupBy("id").agg((F.min(whole) != F.max(whole)).alias("many")).where("many")
    facts = facts.join(own, "id", "left").join(many, "id", "left").where(F.col("many") | (over < F.col("bands")))
    facts = written(facts.select("id", "n", "h", "g"), "facts")
    # sets of the same features: a text of the smallest id stands for them. From here on ``id`` numbers
    # the texts, so that each of an id's sets is one of its own; ``least`` is the document's.
    same = written(facts.groupBy("n", "h", "g").agg(F.min("id").alias("least")), "same")
    ids = same.select(F.col("least").alias("id")).distinct()
    texts = zipped(maybe_in(src.where("text <> ''"), "id", ids), "text").join(ids, "id", "left_semi")
    texts = written(texts.select(F.monotonically_increasing_id().alias("id"), "text", "text_n"), "texts")
    few = written(_with_sets(texts, words, zip_=True), "few")
    reps = few.groupBy("n", "h", "g").agg(F.min("id").alias("lead"))
    reps = written(reps.join(same, ["n", "h", "g"]), "representatives")
    copies = facts.join(reps, ["n", "h", "g"]).select("id", "lead")
    leads = reps.select(F.col("lead").alias("id"))
    # a text that another stands for: few, so that the wide rows stay where they are
    spare = written(few.select("id").join(leads, "id", "left_anti"), "spare")
    # 2. the rarest signatures of each
    rows = exploded(few.select("id", "sigs", "n").join(spare, "id", "left_anti"), "n")
    counts = written(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "counts")
    rows = rows.join(counts, "sig", "left").withColumn("c", F.coalesce("c", F.lit(1)))
    its = W.partitionBy("ref")  # a document's signatures
    ranked = rows.withColumn("r", F.row_number().over(its.orderBy("c", "sig"))).withColumn("own", F.count(F.when(F.col("c") == 1, 1)).over(its)) \
        .where("c > 1").select("sig", F.shiftright("ref", 1).alias("id"), F.col("n").alias("m"), F.col("n").alias("l"), "own", "r")
    budget = F.floor(F.col("m") * (100 - LIKENESS) / LIKENESS).cast("long")
    ranked = written(ranked.select("sig", "id", "m", "l", (F.col("own") / F.col("m")).alias("own"), (F.col("r") <= budget + 1).alias("rare")), "ranked")
    kept = ranked.where("rare").drop("rare")
    # 3. a star a bucket
    # the pivot is sought among all sets with the signature, so that the buckets of a group mostly have the same
    pivot = ranked.groupBy("sig").agg(F.min(F.struct("own", "id", "m", "l")).alias("p"), F.count_if("rare").alias("c")).where("c > 0")
    pivot = written(pivot.select("sig", F.col("p.id").alias("b"), F.col("p.m").alias("mb"), F.col("p.l").alias("lb")), "pivots")
    member = kept.join(pivot, "sig")
    fits = (F.col("m") * 100 >= F.col("lb") * LIKENESS) & (F.col("mb") * 100 >= F.col("l") * LIKENESS)
    pairs = member.where((F.col("id") != F.col("b")) & fits).select(F.col("id").alias("a"), "b").distinct()
    stars = written(_verified(pairs, texts, words), "stars")
    near = F.col("near") >= LIKENESS
    # an id with several texts joins what each of them stands for
    first = copies.groupBy("id").agg(F.min("lead").alias("first"))
    several = copies.join(first, "id").where(F.col("lead") != F.col("first")).select(F.col("lead").alias("a"), F.col("first").alias("b"))
    found = written(connected_components(stars.where(near).select("a", "b").unionByName(several)), "star-components")
    # 4. buckets that hold several components yet
    part = F.coalesce("component", "id")
    placed = member.select("sig", "id", "b", "m", "l").join(found, "id", "left").withColumn("part", part).drop("component")
    placed = written(placed, "placed")
    open_ = written(placed.groupBy("sig").agg((F.min("part") != F.max("part")).alias("o")).where("o").select("sig"), "open-buckets")
    # once for each pivot and set; those outside the pivot's component are compared with all others of the pivot
    left = placed.join(open_, "sig", "left_semi").select("id", "b", "m", "l", "part").distinct() \
        .join(stars.select(F.col("a").alias("id"), "b", "near"), ["id", "b"], "left") \
        .withColumn("far", F.when(F.col("id") == F.col("b"), F.lit(0.0)).otherwise(1 - F.col("near") / 100))
    left = left.join(found.select(F.col("id").alias("b"), F.col("component").alias("pb")), "b", "left").withColumn("pb", F.coalesce("pb", "b"))
    sketches = few.select("id", "n", "p")
    left = written(left.join(sketches, "id").select("id", "b", "n", "part", "far", "p", (F.col("part") != F.col("pb")).alias("out")), "open")
    x, y = left.where("out").alias("x"), left.alias("y")
    close = F.lit(1 - LIKENESS / 100 + 1e-9)
    apart = sum((F.bit_count(F.col("x.p")[k].bitwiseXOR(F.col("y.p")[k])) for k in range(PARITY_WORDS)), F.lit(0))
    # a null distance: not compared with the pivot because of their sizes. Two sets of likeness t differ in
    # (1 - t) / (1 + t) of their sizes' sum at most, and in no fewer features than their sketches do.
    more = x.join(y, (F.col("x.b") == F.col("y.b")) & (F.col("x.part") != F.col("y.part"))
                  & (~F.col("y.out") | (F.col("x.id") < F.col("y.id")))
                  & (F.col("x.n") * 100 >= F.col("y.n") * LIKENESS) & (F.col("y.n") * 100 >= F.col("x.n") * LIKENESS)
                  & (F.col("x.far").isNull() | F.col("y.far").isNull() | (F.abs(F.col("x.far") - F.col("y.far")) <= close))
                  & (apart * (100 + LIKENESS) <= (F.col("x.n") + F.col("y.n")) * (100 - LIKENESS))) \
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    tried = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = _verified(more.join(tried, ["a", "b"], "left_anti"), texts, words)
    # what these add is between components, and little
    places = leads.select("id").join(found, "id", "left").select("id", part.alias("part"))
    added = rest.where(near).join(places.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a") \
        .join(places.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b")
    last = connected_components(added, "pa", "pb").withColumnRenamed("component", "last")
    places = places.join(last.withColumnRenamed("id", "part"), "part", "left").select("id", F.coalesce("last", "part").alias("part"))
    places = written(places.join(reps.select(F.col("lead").alias("id"), "least"), "id"), "places")
    least = places.groupBy("part").agg(F.min("least").alias("component"))
    places = places.select(F.col("id").alias("first"), "part").join(least, "part")
    out = sets.groupBy("id").agg(F.max("n").alias("n_shingles")).join(first, "id", "left").join(places, "first", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
