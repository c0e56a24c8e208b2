"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, lowest first. Level 0 holds a chunk of
every id; a level's bitmap says which ids go on to the next level, where their
next chunks stand in the same order. A rank directory counts the set bits
before each block of the bitmap, so that the place of an id on the next level
is one look-up and a few bit counts: any id can be read on its own.
"""

from __future__ import annotations

import io
import json
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import shuffle_partitions, written
from quarry.llm.encoding import encoder
from quarry.session import scratch_path

MAGIC = b"QDAC1\n"
CHUNK, BLOCK = 8, 512


class Codes:
    """Levels of chunks, bitmaps and rank directories over a sequence of ids."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: int):
        self.levels, self.size = levels, size

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        rest, levels = ids.astype(np.uint32), []
        while True:
            more = rest >> CHUNK
            goes_on = more > 0
            bits = np.packbits(goes_on, bitorder="little")
            padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK, bool)
            padded[: len(rest)] = goes_on
            ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, BLOCK).sum(1))]).astype(np.uint32)
            levels.append(((rest & 0xFF).astype(np.uint8), bits, ranks))
            if not goes_on.any():
                return cls(levels, len(ids))
            rest = more[goes_on]

    def _rank(self, level: int, at: int) -> int:
        """Set bits before ``at``."""
        _, bits, ranks = self.levels[level]
        block = at // BLOCK
        lo, whole = block * BLOCK // 8, at // 8
        n = int(ranks[block]) + int(np.bitwise_count(bits[lo:whole]).sum())
        return n + (int(bits[whole]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else n

    def __getitem__(self, at: int) -> int:
        """One id."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        value, level = int(self.levels[0][0][at]), 0
        while self.levels[level][1][at // 8] >> (at % 8) & 1:
            at = self._rank(level, at)
            level += 1
            value |= int(self.levels[level][0][at]) << (CHUNK * level)
        return value

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``."""
        out = self.levels[0][0][start:stop].astype(np.uint32)
        where = np.arange(stop - start)
        for level in range(len(self.levels) - 1):
            bits = self.levels[level][1]
            on = np.unpackbits(bits[start // 8: -(-stop // 8)], bitorder="little")[start % 8: start % 8 + stop - start].astype(bool)
            where = where[on]
            start = self._rank(level, start)
            stop = start + len(where)
            out[where] |= self.levels[level + 1][0][start:stop].astype(np.uint32) << (CHUNK * (level + 1))
        return out


def to_bytes(ids: np.ndarray, doc_ids: list, starts: np.ndarray) -> bytes:
    """A whole file: magic, length of the header, header (JSON: shapes, and
    document ids), starts of documents, levels."""
    codes = Codes.of(ids)
    arrays = [starts.astype("<u8"), *[a.astype(t) for lv in codes.levels for a, t in zip(lv, ("u1", "u1", "<u4"))]]
    head = json.dumps({"n_tokens": len(ids), "doc_ids": doc_ids, "levels": len(codes.levels),
                       "sizes": [a.nbytes for a in arrays]}).encode()
    out = io.BytesIO()
    out.write(MAGIC + len(head).to_bytes(8, "little") + head)
    for a in arrays:
        out.write(a.tobytes())
    return out.getvalue()


class TokenFile:
    """A file read back: ``codes``, and ``doc(k)`` for the ids of its k-th document."""

    def __init__(self, raw: bytes):
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        at = len(MAGIC) + 8
        n = int.from_bytes(raw[at - 8: at], "little")
        head = json.loads(raw[at: at + n])
        at += n
        parts = []
        for size in head["sizes"]:
            parts.append(raw[at: at + size])
            at += size
        if at != len(raw):
            raise ValueError("token file of another length than its header says")
        self.doc_ids = head["doc_ids"]
        self.starts = np.frombuffer(parts[0], "<u8").astype(np.int64)
        kinds = (np.uint8, np.uint8, "<u4")
        self.codes = Codes([tuple(np.frombuffer(parts[1 + 3 * k + j], kinds[j]) for j in range(3))
                            for k in range(head["levels"])], head["n_tokens"])

    def doc(self, k: int) -> np.ndarray:
        return self.codes.read(int(self.starts[k]), int(self.starts[k + 1]))


def put_file(folder: str, name: str, raw: bytes) -> None:
    """Write under another name, then move: a file is there whole or not at
    all, and a task that runs again puts the same bytes in the same place."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(raw)
    store.move(part, f"{root}/{name}")


def get_file(folder: str, name: str) -> bytes:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{name}") as f:
        return f.read()


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, file_tokens: int = 1 << 24,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, write the ids in
    ascending id order to files of about ``file_tokens`` tokens under
    ``folder`` (a path or URI that all executors share; pyarrow.fs opens it).
    Returns the index (part, k, name, n_docs, n_tokens): files in (part, k)
    order. Null ids come last, a null text is empty, repeated rows are
    documents of their own; documents of one id are in the order of their
    texts' hashes. An empty table writes nothing.

    Documents are range-partitioned on the id before they are encoded, so the
    text is shuffled once and encoded once; a file never spans partitions.
    """
    spark = docs.sparkSession
    order = [F.col("_id").asc_nulls_last(), F.xxhash64("_text")]
    src = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    src = src.repartitionByRange(shuffle_partitions(spark), F.col("_id").asc_nulls_last()).sortWithinPartitions(*order)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        parts, ids, held, rows = [], [], 0, []

        def flush():
            nonlocal parts, ids, held
            starts = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])])
            name = f"part-{part:06d}-{len(rows):06d}.dac"
            put_file(folder, name, to_bytes(np.frombuffer(b"".join(parts), "<u4"), ids, starts))
            rows.append((part, len(rows), name, len(ids), held))
            parts, ids, held = [], [], 0

        for b in batches:
            for lo in range(0, b.num_rows, 250):
                run = b.slice(lo, 250)
                for i, x in zip(run.column(0).to_pylist(), enc.encode(run.column(1).to_pylist())):
                    parts.append(x + end)
                    ids.append(i)
                    held += len(parts[-1]) // 4
                    if held >= file_tokens:
                        flush()
        if parts:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
            pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["part", "k", "name", "n_docs", "n_tokens"])

    return written(src.mapInArrow(write, "part int, k int, name string, n_docs bigint, n_tokens bigint"), "token-index")


def read_token_files(spark: SparkSession, index: DataFrame, folder: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the
    files. ``start`` counts the tokens of all documents before it. The driver
    sums one row a file; a file that does not hold what the index says raises."""
    files = index.select("part", "k", "name", "n_docs", "n_tokens").orderBy("part", "k").collect()
    base, rows = 0, []
    for f in files:
        rows.append((f["name"], base, f["n_docs"], f["n_tokens"]))
        base += f["n_tokens"]
    listed = spark.createDataFrame(rows, "name string, base bigint, n_docs bigint, n_tokens bigint")
    listed = listed.repartition(max(1, min(len(rows), shuffle_partitions(spark))))

    def read(batches):
        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                f = TokenFile(get_file(folder, row["name"]))
                if len(f.doc_ids) != row["n_docs"] or f.codes.size != row["n_tokens"]:
                    raise ValueError(f"{row['name']} does not hold what the index says")
                for lo in range(0, len(f.doc_ids), 1000):
                    ks = range(lo, min(lo + 1000, len(f.doc_ids)))
                    at = f.starts[lo: ks.stop + 1]
                    run = f.codes.read(int(at[0]), int(at[-1])).astype("<u4").tobytes()
                    cuts = (4 * (at - at[0])).tolist()
                    ids = [run[x:y] for x, y in zip(cuts, cuts[1:])]
                    cols = [pa.array(f.doc_ids[lo: lo + 1000], pa.int64()), pa.array(f.starts[ks.start: ks.stop] + row["base"], pa.int64()),
                            pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                    cols += [pa.array(ids, pa.binary())] * keep_ids
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return listed.mapInArrow(read, schema)


def token_folder(spark: SparkSession) -> str:
    """A new folder for files, under the shared checkpoint folder."""
    return scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
