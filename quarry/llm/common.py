"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

#: ASCII white space; words are the runs between it.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut and every later read is the same rows, whichever
    executors are lost. Each call has a folder of its own."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on pure ASCII text and is
    much cheaper there than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(text: bytes) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII white space
    (``bytes.split`` cuts at exactly the characters of ``WHITE``)."""
    return text.translate(LOWER_BYTES).split()


def binary_texts(col) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null counts as empty."""
    import pyarrow as pa

    t = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [b"" if x is None else x for x in col.cast(t).to_pylist()]


def zipped(df: DataFrame, text: str) -> DataFrame:
    """``df`` with its string column ``text`` as zstd bytes, and their length
    as UTF-8 before in ``{text}_n``: whole texts cross a shuffle at half the
    size or less that Spark's own block compression leaves."""
    at = df.columns.index(text)
    fields = [T.StructField(text, T.BinaryType()) if f.name == text else f for f in df.schema.fields]
    schema = T.StructType([*fields, T.StructField(f"{text}_n", T.IntegerType())])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            raw = binary_texts(b.column(at))
            cols = list(b.columns)
            cols[at] = pa.array([pa.compress(x, codec="zstd", asbytes=True) if x else b"" for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([*cols, pa.array([len(x) for x in raw], pa.int32())], schema.names)

    return df.mapInArrow(run, schema)


def unzipped(raw: bytes, n: int) -> bytes:
    import pyarrow as pa

    return pa.decompress(raw, decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def by_bytes(rows: Iterable, size, most: int) -> Iterator[list]:
    """Cut rows into runs of about ``most`` bytes, so that a batch of long
    texts does not take a batch's worth of working memory at once."""
    run, held = [], 0
    for r in rows:
        run.append(r)
        held += size(r)
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker: functions are shipped
    by value, so their module globals start anew with every task."""
    import sys
    import types

    return sys.modules.setdefault("quarry_worker_cache", types.ModuleType("quarry_worker_cache")).__dict__


def forget() -> None:
    """Drops what other operators left in this Python worker's cache and hands
    Arrow's free memory back. Workers are used again and stay for a while
    when idle, so a tokenizer's words would take memory of the steps after it.
    Operators that keep nothing call it as a task begins."""
    import pyarrow as pa

    cache = worker_cache()
    for key in [k for k in cache if ":" in k]:  # the module's own names have none
        cache.pop(key, None)
    pa.default_memory_pool().release_unused()


#: Bits of a row of ``maybe_in``'s bitmap, bits for a key, and bits at most.
BITMAP_ROW, BITS_A_KEY, MOST_BITS = 32768, 16, 1 << 28


def maybe_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the column ``key`` of ``keys``,
    and a few others: put before a semi join that would shuffle all of its
    wide rows only to drop most. The keys' hashes mark the bits of a bitmap
    that every task gets: two bytes a key, and ``MOST_BITS`` at most, past
    which more of the others stay. Null keys are dropped."""
    rows = max(1, min(MOST_BITS // BITMAP_ROW, -(-keys.count() * BITS_A_KEY // BITMAP_ROW)))
    at = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(rows * BITMAP_ROW))
    marks = keys.where(F.col(key).isNotNull()).select(at.alias("_at")) \
        .groupBy(F.expr(f"_at div {BITMAP_ROW}").alias("_row")).agg(F.bitmap_construct_agg(F.col("_at") % BITMAP_ROW).alias("_bits"))
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_at % {BITMAP_ROW} div 8 as int) + 1, 1)), 16, 10) as int)")
    marked = byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0
    return df.where(F.col(key).isNotNull()).withColumn("_at", at) \
        .join(F.broadcast(marks), (F.expr(f"_at div {BITMAP_ROW}") == F.col("_row")) & marked, "left_semi").drop("_at")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over the undirected edges,
    for every id that has an edge to another one.

    Alternating large-star and small-star steps. Each step groups by id with
    partial minima and joins back; the minima are written first, so that the
    join is between two plain shuffles and AQE can split a hot hub. The edge
    list stays distributed and is written to the shared folder after each
    round. Null ends are dropped.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
             .where("u is not null and v is not null and u <> v").distinct()
    e = written(e, "edges")
    if e.isEmpty():
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                               F.struct("u", F.col("m").alias("v")))).alias("e")) \
                     .select("e.u", "e.v").where("u <> v").distinct()
        e = written(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    top = e.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(top) \
            .groupBy("id").agg(F.min("component").alias("component"))
