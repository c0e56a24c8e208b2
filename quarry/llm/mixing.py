"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from quarry.llm.common import WHITE, shuffle_partitions, written

#: Steps into which a source's keys are cut, twice, before rows are put in order.
STEPS = 1024


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """A document's weight from the text alone: 1 for texts of letters,
    digits, blanks and the usual points, falling to 0.25 as other characters
    make up a half."""
    n = F.char_length(text)
    odd = n - F.char_length(F.regexp_replace(text, r"[^\p{L}\p{N}\s.,;:'\"()?-]+", ""))
    return F.when(n > 0, F.greatest(F.lit(0.25), 1 - 1.5 * odd / n)).otherwise(F.lit(1.0))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that is the same in every run: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``number`` (long): the place of ``source`` in code point
    order, null last. The table is range-partitioned, numbered within
    partitions, and the driver adds one count a partition."""
    # the name as it sorts: a null one comes after every other
    src = sizes.withColumn("_null", F.col("source").isNull())
    src = src.repartitionByRange(shuffle_partitions(sizes.sparkSession), "_null", "source").sortWithinPartitions("_null", "source")
    src = written(src.withColumn("_at", F.monotonically_increasing_id()), "sources")
    per = src.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    base, rows = 0, []
    for r in per:
        rows.append((r["p"], base))
        base += r["n"]
    bases = sizes.sparkSession.createDataFrame(rows, "_p bigint, _base bigint")  # a row a partition
    return src.withColumn("_p", F.shiftright("_at", 33)).join(F.broadcast(bases), "_p") \
        .withColumn("number", F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_null", "_p", "_at", "_base")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], total_share: float, most_epochs: float) -> DataFrame:
    """``sizes`` (source, source_size) with ``target`` (double).

    Weights repeat over the sources in code point order, null last.
    ``total_share`` of all sizes is dealt by weight; a target stops at
    ``most_epochs`` times its source's size and what it leaves is dealt again
    by weight to the others, until none is above. Each round is one sum over
    the sources, of which the driver sees three numbers.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    s = written(numbered_sources(sizes).withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(most_epochs)), "weights")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        full = F.col("_cap") < F.col("_w") * F.lit(level) if level is not None else F.lit(False)
        r = s.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0.0)).alias("cap"), F.sum(F.when(full, 0.0).otherwise(F.col("_w"))).alias("w"),
                  F.count(F.when(full, 1)).alias("n")).first()
        if r["n"] == capped or not r["w"]:
            break
        capped, level = r["n"], (total_share * total - r["cap"]) / r["w"]
    dealt = F.col("_w") * F.lit(float(level or 0.0))
    return s.withColumn("target", F.least(F.col("_cap"), dealt)).drop("_w", "_cap", "number")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, most_epochs: float = 2.0,
                seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weight: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """(id, size, source_size, target, taken) of every document, and the columns named in ``carry``.

    ``size`` is the number of words. Each source gets a target
    (``source_targets``). Whole epochs come first: every document is taken as
    often as the target holds its source. The rest is sampled: a document's
    key is -ln(u) / weight with u uniform by its id and text, documents are
    taken in the order of their keys (Efraimidis and Spirakis) while their
    running sum of sizes stays in the rest, and one more closes the gap that is
    left: of the others the one whose size comes nearest to it, if that is
    nearer than none. No document is taken more often than the epochs say,
    rounded up.

    Null and empty texts have size 0 and are taken with 0 words. Null sources
    are one source, the last. Repeated rows have the same key and are put in
    order arbitrarily among themselves, which changes no result. ``weight``
    (default ``quality_weight``) must be above 0. Reruns agree.

    No source is ever in one task: keys are counted in steps, twice, and only
    the rows of the step that a source's budget ends in are put in order, a
    millionth of a large source.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = F.greatest(F.coalesce(weight if weight is not None else quality_weight(text), F.lit(1.0)), F.lit(1e-6))
    u = uniform(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(text)), seed)
    # 1 - u**(1/w) is in the same order as -ln(u)/w, and even over (0, 1) for equal weights
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("_size"),
                       (1 - F.pow(u, 1 / w)).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in carry or []]).alias("_row")
                       if carry else F.lit(None).cast(T.BooleanType()).alias("_row"))
    rows = written(rows.withColumns({"_a": F.floor(F.col("_key") * STEPS).cast("int"), "_rid": F.monotonically_increasing_id(),
                                     "_b": (F.floor(F.col("_key") * (STEPS * STEPS)) % STEPS).cast("int")}), "sized")
    targets = source_targets(rows.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, total_share, most_epochs)
    targets = written(targets.select(
        F.col("source").alias("_s"), "source_size", "target", F.floor(
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).cast("long").alias("_epochs"))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")), "targets")

    narrow = rows.drop("_row")

    def ending(sums: DataFrame, step: str, rest: str) -> DataFrame:
        """The step in which each source's rest ends, and what is left of it there."""
        upto = F.sum("_n").over(W.partitionBy("_s").orderBy(step))  # STEPS rows a source at most
        return sums.withColumn("_upto", upto).where((F.col("_upto") >= F.col(rest)) & (F.col("_upto") - F.col("_n") < F.col(rest))) \
            .select(F.col("_s").alias("_s1"), F.col(step).alias(f"{step}_end"),
                    (F.col(rest) - F.col("_upto") + F.col("_n")).alias(f"{rest}{step}"))

    def add(t: DataFrame, more: DataFrame, name: str) -> DataFrame:
        return written(t.join(more, F.col("_s").eqNullSafe(F.col("_s1")), "left").drop("_s1"), name)

    same = F.col("source").eqNullSafe(F.col("_s"))
    by_a = narrow.groupBy("source", "_a").agg(F.sum("_size").alias("_n")).join(targets, same)
    t = add(targets, ending(by_a, "_a", "_rest"), "first-step")
    by_b = narrow.join(t, same & (F.col("_a") == F.col("_a_end"))).groupBy("_s", "_b", "_rest_a").agg(F.sum("_size").alias("_n"))
    t = add(t, ending(by_b, "_b", "_rest_a"), "second-step")

    # in the last step rows are put in order; (key, row) of the last that is within
    upto = F.sum("_size").over(W.partitionBy("_s").orderBy("_key", "_rid").rowsBetween(W.unboundedPreceding, 0))
    last = narrow.join(t, same & (F.col("_a") == F.col("_a_end")) & (F.col("_b") == F.col("_b_end"))) \
        .withColumn("_upto", upto).where(F.col("_upto") <= F.col("_rest_a_b")) \
        .groupBy(F.col("_s").alias("_s1")).agg(F.max(F.struct("_key", "_rid")).alias("_cut"), F.max("_upto").alias("_got"))
    t = add(t, last, "cut")
    step = F.struct("_a", "_b")
    end = F.struct(F.col("_a_end").alias("_a"), F.col("_b_end").alias("_b"))
    within = F.coalesce((step < end) | ((step == end) & (F.struct("_key", "_rid") <= F.col("_cut"))), F.lit(False))
    gap = F.coalesce(F.col("_rest_a_b") - F.coalesce(F.col("_got"), F.lit(0)), F.lit(0.0))
    off = F.abs(F.col("_size") - gap)
    closing = narrow.join(t, same).where(~within & (F.col("_size") > 0) & (off < gap)) \
        .groupBy(F.col("_s").alias("_s1")).agg(F.min_by("_rid", F.struct(off, F.col("_key"), F.col("_rid"))).alias("_close"))
    t = add(t, closing, "closing")

    times = F.col("_epochs") + (within | F.coalesce(F.col("_rid") == F.col("_close"), F.lit(False))).cast("long")
    return rows.join(t, same).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * times).alias("taken"),
        times.alias("copies"), *[F.col(f"_row.`{c}`").alias(f"row_{c}") for c in carry or []])
