"""Phrase collocations by count transducers.

A count transducer is a weighted acyclic automaton over words: its paths are
n-grams, sorted, and each arc carries how often the n-gram that ends there
occurs. Every task builds transducers from the sorted n-grams of its own shard
of the texts, cut at the same prefix ranges everywhere. The ranges of all
shards are unioned, weights summed, one range at a time, so an n-gram crosses
the shuffle once a shard, whatever its number of occurrences, and a frequent
first word is many ranges. Phrases that occur often enough are then read from
the unions, and the counts of their parts come from composing automata of the
parts asked for with the unions of the same range.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import LOWER_BYTES, binary_texts, by_bytes, mix64, shuffle_partitions, written

#: What ends a piece of text, and what parts words.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Words in a shard, and different ones in it, at most (packed n-grams need 21 bits a word).
SHARD_WORDS, SHARD_KINDS = 1_500_000, 700_000
#: Arcs that a union gathers before it merges them, at least; later as many again as it has.
UNION_ARCS = 1_000_000
#: Prefix ranges in a shuffle partition; a task unions one after the other.
RANGES = 4
#: Sampled n-grams a prefix range; the sample only places the cuts.
SAMPLES = 20

_TABLE = bytearray(LOWER_BYTES)
for _c in ENDS:
    _TABLE[_c] = 10
for _c in GAPS:
    _TABLE[_c] = 32
_TABLE = bytes(_TABLE)


def tokens(texts: list[bytes]) -> list[bytes]:
    """Words of the texts, A-Z lower-cased, and a line feed between pieces and texts (and empty ones)."""
    return b"\n".join([*texts, b""]).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


class Transducer:
    """``words`` sorted; arcs of the root and of the states one and two words
    deep: label (place in ``words``), count (0 if the n-gram ends elsewhere),
    and state that an arc leads to (-1: none). A state is a run of arcs."""

    def __init__(self, words: list[bytes], arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], runs: list[np.ndarray]):
        self.words, self.arcs, self.runs = words, arcs, runs

    def __len__(self) -> int:
        return sum(len(a[0]) for a in self.arcs)

    @staticmethod
    def build(words: list[bytes], w: np.ndarray, n: np.ndarray) -> "Transducer":
        """From distinct sorted n-grams, one a column of ``w`` (1 + place of
        each word, 0 where it has fewer), and their counts. States with equal
        futures are one state."""
        size = w.shape[1]
        new = [np.ones(size, bool)]  # where the prefix of k + 1 words is another than that before
        if size:
            new[0][1:] = w[0, 1:] != w[0, :-1]
        for k in (1, 2):
            new.append(new[-1].copy())
            new[-1][1:] |= w[k, 1:] != w[k, :-1]
        levels = []
        for k in (2, 1, 0):  # deepest first
            at = np.flatnonzero(new[k] & (w[k] > 0))  # the first n-gram with each prefix of k + 1 words
            ends = w[k + 1, at] == 0 if k < 2 else np.ones(len(at), bool)
            parent = np.cumsum(new[k - 1])[at] if k else np.zeros(len(at), np.int64)
            levels.append(((w[k, at] - 1).astype(np.int32), np.where(ends, n[at], 0), parent, np.cumsum(new[k])[at]))
        arcs, runs, state_of = [], [], None  # state_of: (prefix numbers, states) of the level below
        for label, count, parent, own in levels:  # parent, own: numbers of the prefixes without and with the arc
            to = np.full(len(label), -1, np.int32)
            if state_of is not None and len(state_of[0]):
                i = np.minimum(np.searchsorted(state_of[0], own), len(state_of[0]) - 1)
                to = np.where(state_of[0][i] == own, state_of[1][i], -1).astype(np.int32)
            start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.zeros(0, np.int64)
            (label, count, to), run, state = shared_states(start, label, count, to)
            arcs.append((label, count, to))
            runs.append(run)
            state_of = (parent[start], state)
        return Transducer(words, arcs[::-1], runs[::-1])

    def ngrams(self, in_order: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(w, n) as ``build`` takes them."""
        rows, counts = [], []
        label, count, to = self.arcs[0]
        path = [label + 1]
        for k in range(3):
            ends = np.flatnonzero(count)
            rows.append(np.stack([*[p[ends] for p in path], *[np.zeros(len(ends), np.int32)] * (2 - k)]))
            counts.append(count[ends])
            if k == 2:
                break
            src = np.flatnonzero(to >= 0)
            size = self.runs[k + 1][to[src] + 1] - self.runs[k + 1][to[src]]
            at = np.repeat(self.runs[k + 1][to[src]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            path = [np.repeat(p[src], size) for p in path]
            label, count, to = (x[at] for x in self.arcs[k + 1])
            path.append(label + 1)
        w, n = np.concatenate(rows, axis=1), np.concatenate(counts)
        return merged(w, n) if in_order else (w, n)

    def compose(self, counts: "Transducer") -> tuple[np.ndarray, np.ndarray]:
        """(w, n): this automaton's n-grams that ``counts`` has too, with the
        counts there. Paths walk both automata at once, so a state that two
        paths share is met with each path's own state of the other."""
        place = {x: k for k, x in enumerate(counts.words)}
        theirs_of = np.array([place.get(x, -1) for x in self.words] or [-1], np.int64)
        rows, found = [], []
        mine, theirs = np.zeros(min(1, len(self.runs[0]) - 1), np.int64), np.zeros(min(1, len(self.runs[0]) - 1), np.int64)
        path: list[np.ndarray] = []
        for k in range(3):
            # every arc of every path's state, and the other's arc with the same word
            size = self.runs[k][mine + 1] - self.runs[k][mine]
            at = np.repeat(self.runs[k][mine] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            path = [np.repeat(p, size) for p in path]
            label, count, to = (x[at] for x in self.arcs[k])
            label2, count2, to2 = counts.arcs[k]
            if not len(label2) or not len(label):
                break
            key2 = (np.repeat(np.arange(len(counts.runs[k]) - 1), np.diff(counts.runs[k])) << 32) | label2
            key = np.where(theirs_of[label] >= 0, (np.repeat(theirs, size) << 32) | theirs_of[label], -1)
            i = np.minimum(np.searchsorted(key2, key), len(key2) - 1)
            hit = key2[i] == key
            path = [p[hit] for p in path] + [label[hit] + 1]
            ends = (count[hit] > 0) & (count2[i[hit]] > 0)
            rows.append(np.stack([p[ends] for p in path] + [np.zeros(int(ends.sum()), np.int64)] * (2 - k)))
            found.append(count2[i[hit]][ends])
            mine, theirs = to[hit], to2[i[hit]].astype(np.int64)
            on = (mine >= 0) & (theirs >= 0)
            mine, theirs, path = mine[on], theirs[on], [p[on] for p in path]
            if not len(mine):
                break
        if not rows:
            return np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows, axis=1), np.concatenate(found)

    def dumps(self) -> bytes:
        import pyarrow as pa

        head = np.array([len(self.words), *[len(a[0]) for a in self.arcs], *[len(r) for r in self.runs]], "<i8")
        flat = [x.astype(kind) for a in self.arcs for x, kind in zip(a, ("<i4", "<i8", "<i4"))]
        body = b"".join([x.tobytes() for x in (head, *flat, *[r.astype("<i8") for r in self.runs])]) + b"\n".join(self.words)
        return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)

    @staticmethod
    def loads(raw: bytes) -> "Transducer":
        import pyarrow as pa

        body = pa.decompress(raw[8:], decompressed_size=int(np.frombuffer(raw[:8], np.int64)[0]), codec="zstd", asbytes=True)
        head = np.frombuffer(body, "<i8", 7)
        at = 56

        def take(size, kind="<i8"):
            nonlocal at
            x = np.frombuffer(body, kind, int(size), at)
            at += x.nbytes
            return x

        arcs = [tuple(take(n, kind) for kind in ("<i4", "<i8", "<i4")) for n in head[1:4]]
        runs = [take(n) for n in head[4:7]]
        return Transducer(body[at:].split(b"\n") if head[0] else [], arcs, runs)


def shared_states(start, label, count, to):
    """(arcs, runs, state of each old one): states are runs of arcs from
    ``start`` on; equal ones are kept once. They are found by a hash of their
    arcs and compared arc by arc."""
    size = np.diff(np.append(start, len(label)))
    if not len(start):
        return (label, count, to), np.zeros(1, np.int64), np.zeros(0, np.int64)
    mixed = mix64(label.astype(np.uint64) + mix64(count.astype(np.uint64) + mix64((to + 1).astype(np.uint64))))
    digest = mix64(np.add.reduceat(mixed, start) + size.astype(np.uint64))
    _, first, inverse = np.unique(digest, return_index=True, return_inverse=True)
    chief = first[inverse]
    ok = size[chief] == size
    # arcs of each state beside those of its chief (itself where the sizes differ)
    chief = np.where(ok, chief, np.arange(len(start)))
    at = np.arange(len(label))
    theirs = np.repeat(start[chief] - start, size) + at
    same = (label[theirs] == label) & (count[theirs] == count) & (to[theirs] == to)
    chief = np.where(np.logical_and.reduceat(same, start), chief, np.arange(len(start)))
    keep = np.flatnonzero(chief == np.arange(len(start)))
    kept = np.repeat(chief == np.arange(len(start)), size)
    runs = np.concatenate([[0], np.cumsum(size[keep])])
    return (label[kept], count[kept], to[kept]), runs, np.searchsorted(keep, chief)


def packed(w: np.ndarray, bits: int) -> np.ndarray:
    key = w[0].astype(np.int64)
    for k in (1, 2):
        key <<= bits
        key |= w[k]
    return key


def unpacked(key: np.ndarray, bits: int) -> np.ndarray:
    mask = (1 << bits) - 1
    return np.stack([(key >> (2 * bits)).astype(np.int32), ((key >> bits) & mask).astype(np.int32), (key & mask).astype(np.int32)])


def merged(w: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal columns made one, counts summed, sorted."""
    if not w.shape[1]:
        return w, n
    bits = int(w.max()).bit_length()
    if bits <= 21:
        key = packed(w, bits)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return unpacked(key[first], bits), np.add.reduceat(n[order], first)
    else:
        order = np.lexsort(w[::-1])
        s = w[:, order]
        first = np.flatnonzero(np.concatenate([[True], (s[:, 1:] != s[:, :-1]).any(0)]))
    return w[:, order[first]], np.add.reduceat(n[order], first)


def union(parts: list[Transducer]) -> Transducer:
    """One transducer of all paths, weights summed; ``parts`` is emptied."""
    if len(parts) == 1:
        return parts.pop()
    words = sorted(set().union(*[p.words for p in parts]))
    place = {x: k + 1 for k, x in enumerate(words)}
    ws, ns = [], []
    for p in parts:
        own = np.array([0, *[place[x] for x in p.words]], np.int32)
        w, n = p.ngrams(in_order=False)
        ws.append(own[w])
        ns.append(n)
    parts.clear()
    w, n = np.concatenate(ws, axis=1), np.concatenate(ns)
    del ws, ns
    w, n = merged(w, n)
    return Transducer.build(words, w, n)


def pruned(t: Transducer, least: int) -> Transducer:
    """Without n-grams under ``least``, and without words that then stand nowhere."""
    w, n = t.ngrams()
    w, n = w[:, n >= least], n[n >= least]
    used = np.unique(w[w > 0])
    own = np.zeros(len(t.words) + 1, np.int32)
    own[used] = np.arange(1, len(used) + 1)
    return Transducer.build([t.words[k - 1] for k in used], own[w], n)


_END = re.compile(b"[" + ENDS + b"]")


def sliced(texts: list[bytes], size: int = 1 << 20) -> Iterator[bytes]:
    """The texts, long ones cut behind an end of a piece, where no phrase goes on."""
    for text in texts:
        at = 0
        while len(text) - at > size and (m := _END.search(text, at + size)):
            yield text[at:m.end()]
            at = m.end()
        yield text[at:] if at else text


class Shard:
    """Words of one language as they come; ``out`` gives their sorted n-grams."""

    def __init__(self, max_words: int):
        self.m, self.kinds, self.parts, self.size = max_words, {}, [], 0

    def add(self, texts: list[bytes]) -> None:
        import pyarrow as pa

        col = pa.array(tokens(texts), pa.binary()).dictionary_encode()
        own = np.array([0 if x == b"\n" else -1 if not x else self.kinds.setdefault(x, len(self.kinds) + 1)
                        for x in col.dictionary.to_pylist()], np.int32)
        codes = own[col.indices.to_numpy(zero_copy_only=False)]
        self.parts.append(codes[codes >= 0])
        self.size += len(self.parts[-1])

    def full(self) -> bool:
        return self.size > SHARD_WORDS or len(self.kinds) > SHARD_KINDS

    def out(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words, w, n) of all n-grams, as ``Transducer.build`` takes them."""
        words = sorted(self.kinds)
        rank = np.zeros(len(words) + 1, np.int32)
        rank[[self.kinds[x] for x in words]] = np.arange(1, len(words) + 1)
        codes = rank[np.concatenate([*self.parts, np.zeros(2, np.int32)])]
        bits, size = len(words).bit_length(), self.size
        self.parts = []
        # all n-grams packed, those of one word first: filled in place, as copies would hold the memory of several shards
        whole = [codes[:size] > 0]
        for k in range(1, self.m):
            whole.append(whole[-1] & (codes[k:size + k] > 0))
        key, at = np.empty(sum(int(x.sum()) for x in whole), np.int64), 0
        for k, own in enumerate(whole):
            own = np.flatnonzero(own)
            part = key[at:at + len(own)]
            part[:] = codes[own]
            for j in (1, 2):
                part <<= bits
                if j <= k:
                    part |= codes[own + j]
            at += len(own)
        del codes, whole
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(key)))
        self.kinds, self.parts, self.size = {}, [], 0
        return words, unpacked(key[first], bits), n


def _lang(lang) -> str:
    return "und" if lang is None else lang


def range_cuts(docs: DataFrame, ranges: int) -> list[tuple]:
    """(lang, w1, w2, w3) where prefix ranges begin, from ``SAMPLES`` n-grams
    a range; the driver holds ``RANGES`` for each shuffle partition. Equal
    n-grams count once, as they do in a transducer."""
    total = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    every = max(1, total // 6 // (SAMPLES * ranges))  # one word in so many
    rate = min(1.0, 64 / every)
    step = max(1, round(every * rate))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for lang, text in zip(b.column(0).to_pylist(), binary_texts(b.column(1))):
                w = tokens([text])
                for i in range(len(w) % step, len(w), step):
                    key = [x for x in w[i:i + 8] if x][:3]
                    if key and key[0] != b"\n":
                        key = key[:key.index(b"\n")] if b"\n" in key else key
                        rows.append((lang, *key, *[b""] * (3 - len(key))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), *[pa.binary()] * 3))],
                                                 ["lang", "w1", "w2", "w3"])

    got = docs.where(F.rand(7) < rate).select("_lang", "_text").mapInArrow(run, "lang string, w1 binary, w2 binary, w3 binary") \
        .distinct().orderBy("lang", "w1", "w2", "w3").toArrow()
    keys = list(zip(*[c.to_pylist() for c in got.columns])) if got.num_rows else []
    return sorted({keys[k * len(keys) // ranges] for k in range(1, ranges)}) if keys else []


def shard_transducers(docs: DataFrame, cuts: list[tuple], max_words: int) -> DataFrame:
    """(range, lang, automaton): of every shard, the paths of each prefix range."""
    shared = docs.sparkSession.sparkContext.broadcast(cuts)

    def run(batches):
        import pyarrow as pa

        cuts = shared.value
        shards: dict[str, Shard] = {}

        def out(lang):
            words, w, n = shards[lang].out()
            bits = len(words).bit_length()
            key = packed(w, bits)
            lo, hi = bisect.bisect_left(cuts, (lang,)), bisect.bisect_left(cuts, (lang + "\0",))
            ends = [0]
            for _, *cut in cuts[lo:hi]:
                bound, exact = 0, True  # the first packed n-gram at or after the cut
                for x in cut:
                    at = bisect.bisect_left(words, x) if exact and x else len(words)
                    found = exact and bool(x) and at < len(words) and words[at] == x
                    bound = (bound << bits) | ((at + 1) if exact and x else 0)
                    exact = found
                ends.append(max(ends[-1], int(np.searchsorted(key, bound))))
            ends.append(len(key))
            rows = []
            for k, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
                if i == j:
                    continue
                part = w[:, i:j]
                used = np.unique(part[part > 0])
                own = np.zeros(len(words) + 1, np.int32)
                own[used] = np.arange(1, len(used) + 1)
                rows.append((lo + k, lang, Transducer.build([words[u - 1] for u in used], own[part], n[i:j]).dumps()))
            return rows

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.binary()))],
                                              ["range", "lang", "automaton"])

        for b in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), binary_texts(b.column(1))):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                shard = shards.setdefault(lang, Shard(max_words))
                for part in by_bytes(sliced(texts), len, 1 << 20):
                    shard.add(part)
                    if shard.full():
                        if rows := out(lang):
                            yield batch(rows)
        for lang in shards:
            if rows := out(lang):
                yield batch(rows)

    return docs.select("_lang", "_text").mapInArrow(run, "range int, lang string, automaton binary")


def range_transducers(shards: DataFrame, least: int) -> DataFrame:
    """(range, lang, n, automaton): the unions, with ``n`` the words that they
    count; n-grams under ``least`` are left out. Prefixes of an n-gram occur
    as often as it does or more, so they stay."""
    src = shards.repartitionById(shuffle_partitions(shards.sparkSession), F.expr(f"cast(range div {RANGES} as int)")).sortWithinPartitions("range", "lang")

    def run(batches):
        import pyarrow as pa

        at, held, size, most = None, [], 0, UNION_ARCS

        def out():
            t = union(held)
            w, n = t.ngrams(in_order=False)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.string()), pa.array([int(n[w[1] == 0].sum())], pa.int64()),
                 pa.array([pruned(t, least).dumps()], pa.binary())], ["range", "lang", "n", "automaton"])

        for b in batches:
            for k in range(b.num_rows):
                key = (b.column(0)[k].as_py(), b.column(1)[k].as_py())
                if held and key != at:
                    yield out()
                    held, size, most = [], 0, UNION_ARCS
                at = key
                held.append(Transducer.loads(b.column(2)[k].as_py()))
                size += len(held[-1])
                if size > most:
                    held = [union(held)]
                    size = len(held[0])
                    most = max(UNION_ARCS, 2 * size)
        if held:
            yield out()

    return src.mapInArrow(run, "range int, lang string, n bigint, automaton binary")


def phrase_cuts(unions: DataFrame, cuts: list[tuple]) -> DataFrame:
    """(lang, phrase, words, a, k, first, rest, first_range, rest_range): the
    phrases of two words or more, once for each place to cut them."""
    shared = unions.sparkSession.sparkContext.broadcast(cuts)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        cuts = shared.value
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64()), ("k", pa.int32()),
                            ("first", pa.string()), ("rest", pa.string()), ("first_range", pa.int32()), ("rest_range", pa.int32())])
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = Transducer.loads(raw)
                w, n = t.ngrams()
                words = pa.array([b"", *t.words], pa.binary())

                def text(rows):
                    parts = [words.take(pa.array(r)) for r in rows]
                    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())).cast(pa.string()) if len(parts) > 1 \
                        else parts[0].cast(pa.string())

                def ranges(rows):
                    w = np.stack([*rows, *[np.zeros(len(rows[0]), np.int64)] * (3 - len(rows))])
                    kinds, inverse = np.unique(w, axis=1, return_inverse=True)
                    key = [(lang, *(b"" if not x else t.words[x - 1] for x in col)) for col in kinds.T.tolist()]
                    return pa.array(np.array([bisect.bisect_right(cuts, x) for x in key], np.int32)[inverse.ravel()])

                for size in (2, 3):
                    own = (w[size - 1] > 0) & (w[size] == 0 if size < 3 else True)
                    g, c = w[:size, own], n[own]
                    if not len(c):
                        continue
                    whole = text(g)
                    for k in range(1, size):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(c), pa.string()), whole, pa.array(np.full(len(c), size, np.int32)), pa.array(c),
                             pa.array(np.full(len(c), k, np.int32)), text(g[:k]), text(g[k:]), ranges(g[:k]), ranges(g[k:])], schema=schema)

    return unions.select("lang", "automaton").mapInArrow(
        run, "lang string, phrase string, words int, a bigint, k int, first string, rest string, first_range int, rest_range int")


def part_counts(parts: DataFrame, unions: DataFrame) -> DataFrame:
    """(lang, part, f): the automaton of the parts of a range composed with the range's union."""
    def run(key, asked, counts):
        import pyarrow as pa

        tables = {}
        for lang, raw in zip(counts["lang"].to_pylist(), counts["automaton"].to_pylist()):
            tables[lang] = Transducer.loads(raw)
        by_lang: dict[str, list[list[bytes]]] = {}
        for lang, part in zip(asked["lang"].to_pylist(), binary_texts(asked["part"].combine_chunks())):
            by_lang.setdefault(lang, []).append(part.split(b" "))
        langs, names, found = [], [], []
        for lang, grams in by_lang.items():
            if lang not in tables:
                continue
            grams.sort()
            words = sorted({x for g in grams for x in g})
            place = {x: k + 1 for k, x in enumerate(words)}
            w = np.array([[place[x] for x in g] + [0] * (3 - len(g)) for g in grams], np.int64).T
            g, n = Transducer.build(words, w, np.ones(len(grams), np.int64)).compose(tables[lang])
            names += [b" ".join(words[x - 1] for x in col if x).decode() for col in g.T.tolist()]
            found += n.tolist()
            langs += [lang] * len(n)
        return pa.table({"lang": pa.array(langs, pa.string()), "part": pa.array(names, pa.string()), "f": pa.array(found, pa.int64())})

    return parts.groupBy("range").cogroup(unions.select("range", "lang", "automaton").groupBy("range")) \
        .applyInArrow(run, "lang string, part string, f bigint")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10,
                 inside_share: float = 0.5) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, n, score) of every phrase of 2 to
    ``max_words`` (2 or 3) words that occurs ``min_count`` times or more and
    does not mostly stand inside a longer one.

    Texts are cut at ``.,;:!?`` and line ends into pieces, pieces at spaces
    and tabs into words, A-Z lower-cased; phrases lie within pieces. ``a``
    counts the phrase, ``l`` and ``r`` its parts at the cut after ``k`` words
    that scores least (of equal scores the first), ``n`` all words of the
    language. The score is floor(1000000 a a / (l r)), in whole numbers (up to
    3 * 10**15 occurrences). A phrase goes if a longer one that occurs
    ``min_count`` times holds its words and occurs ``inside_share`` times as
    often or more. A null language is ``und``; null and empty texts have no
    words; repeated rows count each. Other columns are ignored.
    """
    if max_words not in (2, 3):
        raise ValueError("max_words must be 2 or 3")
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.col(text_col).alias("_text"))
    cuts = range_cuts(src, RANGES * shuffle_partitions(spark))
    unions = written(range_transducers(shard_transducers(src, cuts, max_words), min_count), "transducers")
    phrases = written(phrase_cuts(unions, cuts), "phrases")
    asked = phrases.select("lang", F.explode(F.array(F.struct(F.col("first").alias("part"), F.col("first_range").alias("range")),
                                                     F.struct(F.col("rest").alias("part"), F.col("rest_range").alias("range")))).alias("p"))
    parts = written(part_counts(asked.select("lang", "p.part", "p.range").distinct(), unions), "parts")
    scored = phrases.join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
        .join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    long = {c: f"cast({c} as decimal(18,0))" for c in "alr"}
    score = F.expr(f"({long['a']} * {long['a']} * 1000000BD) div ({long['l']} * {long['r']})")
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s")) \
        .select("lang", "phrase", "words", "a", "s.*")
    if max_words > 2:
        longer = phrases.where("words = 3 and k = 1").select("lang", "a", F.split("phrase", " ").alias("w")) \
            .select("lang", F.col("a").alias("_longer"), F.explode(F.array(*[
                F.concat_ws(" ", F.col("w")[i], F.col("w")[i + 1]) for i in (0, 1)])).alias("phrase"))
        longer = longer.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
        best = best.join(longer, ["lang", "phrase"], "left") \
            .where(F.col("_longer").isNull() | (F.col("_longer") < F.lit(inside_share) * F.col("a"))).drop("_longer")
    words = unions.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(words, "lang").select("lang", "phrase", "words", "a", "k", "l", "r", "n", "score")


def top_phrases(found: DataFrame, most: int = 2000) -> DataFrame:
    """Each language's first ``most`` by score, then count, then bytes, with ``rank`` from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
