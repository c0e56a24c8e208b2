"""Line dedup: drop lines whose normalised key is found in many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WHITE, ascii_lower, written


def _keys(text: Column) -> Column:
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)))


#: 96 bits of a key: two independent hashes, so that equal pairs mean equal keys at any size of corpus.
_HASHES = (F.xxhash64, "_h"), (F.hash, "_g")


def _hashed(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, *[f("_key").alias(n) for f, n in _HASHES])


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text's repeated lines taken out, plus
    ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ASCII white space and with A-Z
    lower-cased. A key of at least ``min_chars`` code points that is found in
    at least ``min_docs`` documents loses all its lines, the first one too.
    The other lines stay as they were, in order, joined by a newline.

    Every row is one document, so a repeated row counts again. A null or
    empty text is one empty line and comes back as an empty text. Rows with a
    null id are documents like any other. Columns of ``docs`` named
    ``n_lines`` or ``n_dropped`` are replaced; other extra columns stay.

    Keys are counted as hashes with map-side partial sums; frequent keys find
    their lines by an equi-join on the hash (a hot key is split by AQE's skew
    join); only (document, position) of dropped lines is regrouped, and the
    text is shuffled once.
    """
    given = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in given]).alias("_row"), F.col(id_col).alias("_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_t", F.xxhash64("_text"))
    long_enough = F.char_length("_key") >= min_chars

    once = base.select(F.explode(F.array_distinct(_keys(F.col("_text")))).alias("_key")).where(long_enough)
    # written, so that the join below is between plain shuffles and AQE can split a hot line
    frequent = _hashed(once).groupBy("_h", "_g").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= min_docs)
    frequent = written(frequent.select("_h", "_g"), "frequent-lines")
    lines = base.select("_id", "_t", F.posexplode(_keys(F.col("_text"))).alias("_pos", "_key")).where(long_enough)
    dropped = _hashed(lines, "_id", "_t", "_pos").join(frequent, ["_h", "_g"], "left_semi") \
        .groupBy(F.col("_id").alias("_i"), F.col("_t").alias("_u")) \
        .agg(F.array_distinct(F.collect_list("_pos")).alias("_drop"))

    whole = base.join(dropped, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_t") == F.col("_u")), "left") \
        .withColumn("_lines", F.split("_text", "\n", -1))
    # array_except on positions is hashed, so a text of very many lines stays linear
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drop"))
    kept = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return whole.select(*[kept.alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in given],
                        F.size("_lines").cast("long").alias("n_lines"),
                        F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size("_drop")).cast("long").alias("n_dropped"))
