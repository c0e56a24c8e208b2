"""LM scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` long with the counts of
what followed them in the training texts. A byte that did not follow the
longest known context escapes to the next shorter one (PPM method C: the
escape weighs as many as there are different followers), where the followers
of the longer one are excluded. As all counts come from one corpus, followers
of a context also follow its suffix, so what an escape excludes depends on the
context alone and is summed beforehand.

The grams (context and follower of the longest order) are dealt into shards by
the last three bytes of the context, as many as the shuffle has partitions.
Training texts send their counts there, every text its different grams with
the rows that have them, and a shard makes its trie once and sends back sums
by row. No table of grams passes through the driver or is held by every task;
only the counts of the shortest contexts are, at most 2^24 of them whatever
the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import binary_texts, by_bytes, mix64, shuffle_partitions, words_of, written

#: Longest context in bytes; a gram (context and follower) must fit 63 bits.
ORDER = 5
#: What stands before a text's first byte, and after its last.
START, END = 10, 10
#: Bytes of text that are handled at once, and rows of one batch, at most (a row's number stands beside its gram in 63 bits).
PART_BYTES, BATCH_ROWS = 1 << 21, 1 << 15
#: Grams that a task counts before it sends them, and bytes that it asks about at once.
COUNTED, ASKED_BYTES = 10_000_000, 1 << 22
#: The most frequent words, whose counts every task holds; other counts are joined.
COMMON_WORDS = 200_000


def in_training(doc_id: Column) -> Column:
    """Whether the model learns from a document: CRC-32 of its id as text modulo 5 is not 1."""
    return F.crc32(doc_id.cast("string")) % 5 != 1


def modelled(text: bytes) -> bytes:
    """The bytes that are modelled: the words, one space between, and an end."""
    return b"".join(pieces(text))


def pieces(text: bytes) -> Iterator[bytes]:
    """``modelled``, piece by piece for long texts; a word that a cut parts stays whole."""
    held, open_word = None, False
    for at in range(0, max(len(text), 1), PART_BYTES):
        cut = text[at:at + PART_BYTES]
        words = words_of(cut)
        if words:
            if held is not None:
                yield held + (b"" if open_word and not cut[:1].isspace() else b" ")
            held = b" ".join(words)
        open_word = bool(words) and not cut[-1:].isspace()
    yield (held or b"") + bytes([END])


def texts_of(col) -> Iterator[bytes]:
    """``binary_texts`` a few rows at a time: a batch of Arrow holds thousands of texts."""
    for at in range(0, len(col), 256):
        yield from binary_texts(col.slice(at, 256))


def runs(texts: Iterable[bytes], most: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """(number of the text, the ``ORDER`` bytes before, piece) of all texts, in lists of about ``most`` bytes."""
    def each():
        for k, text in enumerate(texts):
            before = bytes([START]) * ORDER
            for piece in pieces(text):
                yield k, before, piece
                before = (before + piece)[-ORDER:]

    return by_bytes(each(), lambda x: len(x[2]), most)


def grams(parts: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(gram of each byte of each piece, number of bytes of each)."""
    a = np.frombuffer(b"".join([before + piece for _, before, piece in parts]), np.uint8).astype(np.int64)
    size = np.fromiter((len(p) for _, _, p in parts), np.int64, len(parts))
    g = np.zeros(max(0, len(a) - ORDER), np.int64)
    for k in range(ORDER + 1):
        g <<= 8
        g |= a[k: len(a) - ORDER + k]
    # the positions whose gram ends in a piece's own bytes
    first = np.cumsum(size + ORDER) - size - ORDER
    keep = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return g[keep], size


def shard_of(gram: np.ndarray, shards: int) -> np.ndarray:
    return (mix64((gram >> 8) & 0xFFFFFF) % np.uint64(shards)).astype(np.int64)


def by_shard(gram: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places in ``gram``, in order) of every shard that has any."""
    of = shard_of(gram, shards)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], of[order][1:] != of[order][:-1]])) if len(order) else np.zeros(0, np.int64)
    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        yield int(of[order[i]]), order[i:j]


def zip_arrays(*arrays: np.ndarray) -> bytes:
    import pyarrow as pa

    # the bytes of like worth together: numbers are mostly small
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    body = b"".join([np.array([len(a) for a in arrays], "<i8").tobytes(), *planes])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unzip_arrays(raw: bytes, *kinds: str) -> list[np.ndarray]:
    import pyarrow as pa

    body = pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    out, at = [], 8 * len(kinds)
    for n, kind in zip(np.frombuffer(body, "<i8", len(kinds)).tolist(), kinds):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def places(gap: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ascending numbers from their gaps, in runs of ``size`` that start anew."""
    upto = np.cumsum(gap, dtype=np.int64)
    start = np.cumsum(size, dtype=np.int64) - size
    return upto - np.repeat(upto[start] - gap[start], size)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sum of ``n`` of each."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def gram_counts(train: DataFrame, shards: int, text_col: str = "_text") -> DataFrame:
    """(shard, data): counts of the grams of all texts, by task and shard."""
    def run(batches):
        import pyarrow as pa

        held, size = np.empty(COUNTED, np.int64), 0  # filled in place: lists of parts would hold twice as much

        def out():
            g = held[:size]
            g.sort()
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if size else np.zeros(0, np.int64)
            n = np.diff(np.append(first, size))
            g = g[first]
            rows = [(s, zip_arrays(np.diff(g[at], prepend=0), n[at])) for s, at in by_shard(g, shards)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

        for b in batches:
            for part in runs(texts_of(b.column(0)), PART_BYTES):
                g, _ = grams(part)
                for at in range(0, len(g), COUNTED):
                    some = g[at:at + COUNTED]
                    if size + len(some) > COUNTED:
                        yield out()
                        size = 0
                    held[size:size + len(some)] = some
                    size += len(some)
        if size:
            yield out()

    return train.select(F.col(text_col)).mapInArrow(run, "shard int, data binary")


def short_counts(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(gram of two context bytes and follower, n), sorted: 2^24 at most, which bytes alone bound."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for raw in b.column(0).to_pylist():
                d, n = unzip_arrays(raw, "<i8", "<i8")
                key, m = summed(np.cumsum(d) & 0xFFFFFF, n)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(m)], ["key", "n"])

    got = counts.select("data").mapInArrow(run, "key int, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    key, n = got["key"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.int64)
    order = np.argsort(key)
    return key[order], n[order]


class Trie:
    """Contexts of orders 0 to ``ORDER`` and their followers. ``gram``, sorted,
    and ``n`` are those of one shard; ``short`` are all grams of two context
    bytes and their counts, from which orders 0 to 2 come."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray]):
        self.edge, self.edge_n, self.node, self.total, self.kinds, self.gone = [], [], [], [], [], []
        for k in range(ORDER + 1):
            if k <= 2:
                e, c = short if k == 2 else summed(short[0] & ((1 << (8 * (k + 1))) - 1), short[1])
            elif k == ORDER:  # sorted and distinct as they are
                e, c = gram, n
            else:
                e, c = summed(gram & ((1 << (8 * (k + 1))) - 1), n)
            node, first = np.unique(e >> 8, return_index=True)
            self.edge.append(e)
            self.edge_n.append(c)
            self.node.append(node)
            self.total.append(np.add.reduceat(c, first) if len(c) else c)
            self.kinds.append(np.diff(np.append(first, len(e))).astype(np.int16))  # 256 at most
            # counts that the followers of each context have after its suffix: excluded there
            if k:
                at = np.searchsorted(self.edge[k - 1], e & ((1 << (8 * k)) - 1))
                self.gone.append(np.add.reduceat(self.edge_n[k - 1][at], first) if len(e) else c)
            else:
                self.gone.append(np.zeros(len(node), np.int64))

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """Log probability of each gram's last byte after its context."""
        out = np.zeros(len(gram))
        open_ = np.ones(len(gram), bool)  # not coded yet
        gone, kinds = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)  # excluded at the next order
        for k in range(ORDER, -1, -1):
            i = np.flatnonzero(open_)
            if not len(i) or not len(self.node[k]):
                continue
            g = gram[i] & ((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(self.node[k], g >> 8), len(self.node[k]) - 1)
            known = self.node[k][at] == g >> 8
            i, g, at = i[known], g[known], at[known]
            left, new = self.total[k][at] - gone[i], self.kinds[k][at] - kinds[i]
            e = np.minimum(np.searchsorted(self.edge[k], g), len(self.edge[k]) - 1)
            hit = self.edge[k][e] == g
            room = np.maximum(left + new, 1).astype(float)
            # without a new follower there is nothing but the escape
            p = np.where(hit, self.edge_n[k][e], np.where(new > 0, new, room)) / room
            out[i] += np.log10(p)
            open_[i[hit]] = False
            gone[i], kinds[i] = self.gone[k][at], self.kinds[k][at]
        i = np.flatnonzero(open_)
        out[i] -= np.log10(256.0 - np.minimum(kinds[i], 255))
        return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_rid, _id, _text), written: every row, repeated ones and null ids too,
    has a key of its own: the number of its batch and, in the last 15 bits,
    its place there."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("_rid", T.LongType()), T.StructField("_id", id_type), T.StructField("_text", T.StringType())])

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        batch, place, held = TaskContext.get().partitionId() << 24, 0, 0
        for b in batches:
            rid = []
            for size in pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist():
                if place == BATCH_ROWS or held > ASKED_BYTES:
                    batch, place, held = batch + 1, 0, 0
                rid.append((batch << 15) | place)
                place, held = place + 1, held + size
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), *b.columns], ["_rid", "_id", "_text"])

    return written(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema), "rows")


def asked(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, batch, data): the different grams of the texts of a batch, with
    the places in the batch of the texts that have each, and how often."""
    def run(batches):
        import pyarrow as pa

        def out(batch, places, texts):
            for part in runs(texts, ASKED_BYTES):
                g, size = grams(part)
                key = (g << 15) | np.repeat(np.array([places[k] for k, _, _ in part], np.int64), size)
                del g
                key.sort()
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                times = np.diff(np.append(first, len(key)))  # of each gram in each text
                key = key[first]
                row, key = (key & 0x7FFF).astype("<u2"), key >> 15
                start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                texts_of, gram = np.diff(np.append(start, len(key))), key[start]
                head = row[start]
                row[1:] -= row[:-1].copy()  # the gap to the text before with the same gram
                row[start] = head
                rows_out = []
                for s, at in by_shard(gram, shards):
                    size = texts_of[at]
                    pair = np.repeat(start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                    rows_out.append((s, batch, zip_arrays(np.diff(gram[at], prepend=0), size.astype("<u2"), row[pair], times[pair].astype("<u4"))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_out), (pa.int32(), pa.int64(), pa.binary()))],
                                                 ["shard", "batch", "data"])

        batch, places, texts = None, [], []
        for b in batches:
            for rid, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                if texts and rid >> 15 != batch:
                    yield from out(batch, places, texts)
                    places, texts = [], []
                batch = rid >> 15
                places.append(rid & 0x7FFF)
                texts.append(text)
        if texts:
            yield from out(batch, places, texts)

    return rows.select("_rid", "_text").mapInArrow(run, "shard int, batch bigint, data binary")


def answered(counts: DataFrame, asks: DataFrame, short: tuple[np.ndarray, np.ndarray], shards: int) -> DataFrame:
    """(_rid, score): sums by row of the log probabilities of all shards' grams.
    Counts and questions of a shard meet in one sorted stream, counts first; a
    task holds one trie and one question."""
    shared = counts.sparkSession.sparkContext.broadcast(short)
    stream = counts.select("shard", F.lit(None).cast("bigint").alias("batch"), "data").unionByName(asks) \
        .repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("batch").asc_nulls_first())

    def run(batches):
        import pyarrow as pa

        shard, held, trie = None, [], None
        for b in batches:
            for k in range(b.num_rows):
                s, batch = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                if s != shard:
                    shard, held, trie = s, [], None
                raw = b.column(2)[k].as_py()
                if batch is None:
                    d, n = unzip_arrays(raw, "<i8", "<i8")
                    held.append((np.cumsum(d), n))
                    continue
                if trie is None:
                    none = np.zeros(0, np.int64)
                    trie = Trie(*summed(np.concatenate([none, *[x[0] for x in held]]), np.concatenate([none, *[x[1] for x in held]])), shared.value)
                    held = []
                d, size, gap, times = unzip_arrays(raw, "<i8", "<u2", "<u2", "<u4")
                row = places(gap, size)
                value = np.repeat(trie.log10(np.cumsum(d)), size) * times
                there = np.flatnonzero(np.bincount(row))
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([zip_arrays(there.astype("<u2"), np.bincount(row, value)[there])])],
                                                 ["batch", "data"])

    return row_sums(stream.mapInArrow(run, "batch bigint, data binary"), ["score"])


def row_sums(parts: DataFrame, columns: list[str]) -> DataFrame:
    """(_rid, columns as doubles): sums by row of (batch, data), data being
    places in the batch and a number a column for each. A shard's part of a
    batch stays one row up to here, so that the rows in between do not grow as
    texts times shards; a task adds up one batch at a time."""
    stream = parts.repartition(shuffle_partitions(parts.sparkSession), "batch").sortWithinPartitions("batch")

    def run(batches):
        import pyarrow as pa

        names = ["_rid", *columns]
        at, total, seen = None, np.zeros((len(columns), BATCH_ROWS)), np.zeros(BATCH_ROWS, bool)

        def out():
            row = np.flatnonzero(seen)
            got = pa.RecordBatch.from_arrays([pa.array((at << 15) | row.astype(np.int64)), *[pa.array(t[row]) for t in total]], names)
            total[:, row] = 0
            seen[row] = False
            return got

        for b in batches:
            for batch, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if at is not None and batch != at:
                    yield out()
                at = batch
                row, *values = unzip_arrays(raw, "<u2", *["<f8"] * len(columns))
                seen[row] = True
                for t, v in zip(total, values):
                    t[row] += v  # a place stands once in a part
        if at is not None:
            yield out()

    return stream.mapInArrow(run, ", ".join(["_rid bigint", *[f"{c} double" for c in columns]]))


def ppm_scores(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): log10 probability of each text under the trie of all
    texts of ``train``. The text modelled is its words, A-Z lower-cased, with
    one space between, and an end; a null or empty text is the end alone.
    Repeated rows are scored one by one. Without any training text every byte
    has probability 1/256."""
    rows = keyed(docs, id_col, text_col)
    return ppm_of(rows, train, text_col).join(rows.select("_rid", "_id"), "_rid").select(F.col("_id").alias(id_col), "score")


def ppm_of(rows: DataFrame, train: DataFrame, text_col: str) -> DataFrame:
    """(_rid, score) of ``ppm_scores`` for ``keyed`` rows. Training texts are read once and all texts once."""
    shards = shuffle_partitions(rows.sparkSession)
    counts = written(gram_counts(train, shards, text_col), "grams")
    return answered(counts, asked(rows, shards), short_counts(counts), shards)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; a worker holds 250,000 words and a text's at a time."""
    def run(batches):
        import pyarrow as pa

        held: Counter = Counter()

        def out():
            keys = list(held)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([held[k] for k in keys], pa.int64())], ["word", "n"])

        for b in batches:
            for t in texts_of(b.column(0)):
                held.update(words_of(t))
                if len(held) > 250_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select(F.col(text_col)).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def base_scores(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score): a unigram model of
    words and one end a text. ``base_score`` is the sum over a text's tokens of
    log10((c + 0.5) / (N + 0.5 (V + 1))): c how often the token is in
    training, N all training tokens, V how many are different; ``n_known``
    counts tokens with c above 0. Repeated rows are scored one by one, and so
    are rows with a null id.
    """
    rows = keyed(docs, id_col, text_col)
    return base_of(rows, train, text_col).join(rows.select("_rid", "_id"), "_rid") \
        .select(F.col("_id").alias(id_col), "n_tokens", "n_known", "train_tokens", "base_score")


def base_of(rows: DataFrame, train: DataFrame, text_col: str) -> DataFrame:
    """(_rid, n_tokens, n_known, train_tokens, base_score) of ``base_scores``
    for ``keyed`` rows.

    Every task holds the counts of the most frequent words, ``COMMON_WORDS``
    at most; they are also the hot keys. Other words are asked about by shard
    as grams are: each batch's different ones with the rows that have them.
    """
    spark = rows.sparkSession
    shards = shuffle_partitions(spark)
    counts = written(word_counts(train, text_col), "words")
    ends = train.count()
    words, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    n = (words or 0) + ends
    norm = n + 0.5 * (distinct + (ends > 0) + 1)
    end_score, end_known = math.log10((ends + 0.5) / norm), int(ends > 0)
    common = counts.orderBy(F.col("n").desc(), "word").limit(COMMON_WORDS).toArrow()
    table = spark.sparkContext.broadcast((common["word"].to_pylist(), np.log10((common["n"].to_numpy() + 0.5) / norm)))

    def by_word(words: list[bytes]) -> list[tuple[int, np.ndarray]]:
        of = np.fromiter((zlib.crc32(w) % shards for w in words), np.int64, len(words))
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], of[order][1:] != of[order][:-1]])) if len(order) else np.zeros(0, np.int64)
        return [(int(of[order[i]]), order[i:j]) for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)])]

    def bundles(batches):
        import pyarrow as pa

        for b in batches:
            words, times = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False).astype("<i8")
            out = [(s, zip_arrays(np.frombuffer(b"\n".join([words[k] for k in at.tolist()]), np.uint8), times[at])) for s, at in by_word(words)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["shard", "data"])

    def ask(batches):
        import pyarrow as pa

        known = dict(zip(table.value[0], table.value[1].tolist()))

        def out(batch, held):
            row, tokens, knowns, scores, rare = [], [], [], [], {}
            for place, text in held:
                w = words_of(text)
                seen = list(map(known.get, w))
                got = [s for s in seen if s is not None]
                row.append(place)
                tokens.append(len(w) + 1)
                knowns.append(len(got) + end_known)
                scores.append(math.fsum(got) + end_score)
                for x, m in Counter([x for x, s in zip(w, seen) if s is None]).items():
                    rare.setdefault(x, []).append((place, m))
            # a row's common words and its end are answered at once, in no shard
            rows_out = [(-1, batch, zip_arrays(*[np.array(x, t) for x, t in zip((row, tokens, knowns, scores), ("<u2", "<i8", "<i8", "<f8"))]))]
            words = list(rare)
            for s, at in by_word(words):
                own = [words[k] for k in at.tolist()]
                pairs = [p for x in own for p in rare[x]]
                rows_out.append((s, batch, zip_arrays(np.frombuffer(b"\n".join(own), np.uint8), np.array([len(rare[x]) for x in own], "<u2"),
                                                      np.array([p[0] for p in pairs], "<u2"), np.array([p[1] for p in pairs], "<u4"))))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_out), (pa.int32(), pa.int64(), pa.binary()))],
                                              ["shard", "batch", "data"])

        batch, held = None, []
        for b in batches:
            for rid, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                if held and rid >> 15 != batch:
                    yield out(batch, held)
                    held = []
                batch = rid >> 15
                held.append((rid & 0x7FFF, text))
        if held:
            yield out(batch, held)

    def answer(batches):
        import pyarrow as pa

        shard, known = None, {}
        for b in batches:
            for k in range(b.num_rows):
                s, batch, raw = b.column(0)[k].as_py(), b.column(1)[k].as_py(), b.column(2)[k].as_py()
                if s != shard:
                    shard, known = s, {}
                if batch is None:
                    text, times = unzip_arrays(raw, "u1", "<i8")
                    known.update(zip(text.tobytes().split(b"\n"), times.tolist()))
                    continue
                if s == -1:
                    row, tokens, found, score = unzip_arrays(raw, "<u2", "<i8", "<i8", "<f8")
                else:
                    text, size, pair_row, times = unzip_arrays(raw, "u1", "<u2", "<u2", "<u4")
                    c = np.repeat(np.fromiter((known.get(w, 0) for w in text.tobytes().split(b"\n")), np.int64, len(size)), size)
                    row = np.flatnonzero(np.bincount(pair_row)).astype("<u2")
                    tokens = np.zeros(len(row))
                    found = np.bincount(pair_row, np.where(c > 0, times, 0))[row]
                    score = np.bincount(pair_row, np.log10((c + 0.5) / norm) * times)[row]
                data = zip_arrays(row, tokens.astype("<f8"), found.astype("<f8"), score)
                yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([data], pa.binary())], ["batch", "data"])

    asks = rows.select("_rid", "_text").mapInArrow(ask, "shard int, batch bigint, data binary")
    stream = counts.mapInArrow(bundles, "shard int, data binary").select("shard", F.lit(None).cast("bigint").alias("batch"), "data").unionByName(asks) \
        .repartitionById(shards, F.expr(f"if(shard < 0, cast(pmod(batch, {shards}) as int), shard)")).sortWithinPartitions("shard", F.col("batch").asc_nulls_first())
    out = row_sums(stream.mapInArrow(answer, "batch bigint, data binary"), ["n_tokens", "n_known", "base_score"])
    return out.select("_rid", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("n_known").cast("long").alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), "base_score")


def score_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every document; both models learn from the documents of ``in_training``
    (a null id is held out). Repeated rows are documents of their own, and so
    are rows with a null id."""
    rows = keyed(docs, id_col, text_col)
    train = rows.where(in_training(F.col("_id")))
    out = rows.select("_rid", "_id").join(base_of(rows, train, "_text"), "_rid").join(ppm_of(rows, train, "_text"), "_rid")
    return out.withColumn("held_out", ~F.coalesce(in_training(F.col("_id")), F.lit(False))) \
        .select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
