"""Best-fit packing of documents into sequences by bin completion."""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_bytes, written
from quarry.llm.encoding import LOOKED_UP, encoder


class Sizes:
    """Free items by size, as bit sets: which sizes there are (bit ``s``), the
    same mirrored (bit ``capacity - s``), and how many of each. Pairs that sum
    to a number are then one shift and one ``and``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.count = capacity, dict(counts)
        self.there = self.mirror = 0
        for s in self.count:
            self.there |= 1 << s
            self.mirror |= 1 << (capacity - s)

    def take(self, s: int) -> None:
        self.count[s] -= 1
        if not self.count[s]:
            self.there ^= 1 << s
            self.mirror ^= 1 << (self.capacity - s)

    def put(self, s: int) -> None:
        n = self.count.get(s, 0)
        self.count[s] = n + 1
        if not n:
            self.there |= 1 << s
            self.mirror |= 1 << (self.capacity - s)

    def largest(self, most: int) -> int:
        """The largest free size up to ``most``; 0 if none."""
        return (self.there & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 and self.there & ((1 << (most + 1)) - 1) else 0

    def pairs(self, total: int, most: int | None = None):
        """(a, b), a >= b, free sizes that sum to ``total``, a up to ``most``; larger a first."""
        both = self.there & (self.mirror >> (self.capacity - total)) & ((1 << (total if most is None else min(total, most + 1))) - 1)
        both >>= (total + 1) // 2  # a is the larger half
        low = (total + 1) // 2
        while both:
            a = both.bit_length() - 1 + low
            both ^= 1 << (a - low)
            if a < total and (2 * a != total or self.count[a] >= 2):
                yield a, total - a


class Fillings:
    """Fillings of one bin by free items, whatever their number."""

    def __init__(self, free: Sizes, room: int):
        self.free, self.room, self.sizes = free, room, None

    def undominated(self, spare: int):
        """All undominated fillings that leave ``spare`` at most, the fullest
        first, of equal ones single items, pairs, threes, then the rest by
        their largest items; None for each step between them. ``free`` must be
        the same at each step, and is left as it is.

        A filling is dominated if a free item could be added, or if one of its
        items, or two together, could be exchanged for a larger free item or
        one of their sum without running over: the exchange leaves small
        items, which fit wherever the large one would.
        """
        for fill in range(self.room, max(self.room - spare, 0) - 1, -1):
            for filling in self._exactly(fill):
                yield filling if filling is not None and not self._dominated(filling, self.room - fill) else None

    def greedy(self) -> tuple[int, ...]:
        """The best fit item by item."""
        out, left = [], self.room
        while s := self.free.largest(left):
            self.free.take(s)
            out.append(s)
            left -= s
        for s in out:
            self.free.put(s)
        return tuple(out)

    def _dominated(self, filling: tuple[int, ...], waste: int) -> bool:
        there, mine = self.free.there, Counter(filling)
        for s, n in mine.items():
            if self.free.count[s] == n:
                there ^= 1 << s
        if there & ((1 << (waste + 1)) - 1):
            return True
        if waste and any((there >> (s + 1)) & ((1 << waste) - 1) for s in mine):
            return True
        up_to = (1 << (waste + 1)) - 1
        return any((there >> (a + b)) & up_to for a, b in {(filling[i], filling[j]) for j in range(len(filling)) for i in range(j)})

    def _exactly(self, fill: int):
        """Fillings that sum to ``fill``; None for each step between them."""
        free = self.free
        if not fill:
            yield ()
            return
        if free.count.get(fill):
            yield (fill,)
        yield from free.pairs(fill)
        first = free.largest(fill - 2)
        while 3 * first >= fill:
            yield None
            for a, b in free.pairs(fill - first, first):
                n = (a == first) + (b == first)
                if free.count[first] > n:
                    yield first, a, b
            first = free.largest(first - 1)
        if self.sizes is None:
            # reach[i]: the sums that the i smallest sizes have
            sizes, reach, fits = [], [1], (2 << self.room) - 1
            rest = free.there & fits
            while rest:
                yield None
                s = (rest & -rest).bit_length() - 1
                rest &= rest - 1
                sums, left, k = reach[-1], min(free.count[s], self.room // s), 1
                while left:
                    sums |= (sums << (s * min(k, left))) & fits
                    left, k = left - min(k, left), 2 * k
                sizes.append(s)
                reach.append(sums)
            self.sizes, self.reach = sizes, reach
        for filling in self._below(fill, bisect_right(self.sizes, fill)):
            yield filling if filling and len(filling) > 3 else None

    def _below(self, fill: int, i: int):
        """Fillings that sum to ``fill`` by the ``i`` smallest sizes, by the
        largest items; a step that cannot end in one is not taken."""
        while i and self.reach[i] >> fill & 1:
            i -= 1
            s = self.sizes[i]
            yield None
            for m in range(min(self.free.count[s], fill // s), 0, -1):
                if m * s == fill:
                    yield (s,) * m
                elif self.reach[i] >> (fill - m * s) & 1:
                    for rest in self._below(fill - m * s, i):
                        yield (s,) * m + rest if rest else None


def best_fit(sizes: dict[int, int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item to the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for s in sorted(sizes, reverse=True):
        for _ in range(sizes[s]):
            fits = rooms >> s
            if fits:
                r = (fits & -fits).bit_length() - 1 + s
                k = by_room[r].pop()
                if not by_room[r]:
                    rooms ^= 1 << r
            else:
                r, k = capacity, len(bins)
                bins.append([])
            bins[k].append(s)
            if r > s:
                by_room.setdefault(r - s, []).append(k)
                rooms |= 1 << (r - s)
    return bins


#: Full bins by which a repacked part grows from try to try, those up to which it does, and the effort of a try.
REPACK_STEP, REPACK_GROWN, REPACK_EFFORT = 3, 45, 40
#: Full bins that are picked first, tries of each number of them, and tries until each has as much effort again.
PICKED, PICKS, PATIENCE = 12, 4, 40


def least_bins(sizes: dict[int, int], capacity: int) -> int:
    """A bin for each unit of capacity, and one for each item over half of it."""
    return max(-(-sum(s * n for s, n in sizes.items()) // capacity), sum(n for s, n in sizes.items() if 2 * s > capacity))


def repacked(bins: list[list[int]], capacity: int, bound: int, effort: int) -> list[list[int]]:
    """``bins``, or fewer if parts of them fit in fewer.

    Nearly all bins of best-fit decreasing are full, and what is lost lies in
    the others. These and the full bins of the most items, a few more from try
    to try, are searched on their own, then these and full bins picked by
    chance among those of the most items: where some do not help, others
    mostly do, and many short tries find them sooner than a few long ones. All
    tries have no more steps than the search of all bins, so that where none
    helps the work is doubled at most. Reruns pick the same.
    """
    left, each, rng = effort * len(bins), min(effort, REPACK_EFFORT), random.Random(0)
    while len(bins) > bound:
        ends = [b for b in bins if sum(b) < capacity]
        full = sorted([b for b in bins if sum(b) == capacity], key=lambda b: (-len(b), min(b)))
        for which, more in _parts(sum(len(b) > 1 for b in full), rng):
            part = ends + [full[i] for i in which]
            left -= each * more * len(part)
            if left < 0:
                return bins
            fewer = searched(part, capacity, each * more)
            if len(fewer) < len(part):
                taken = set(which)
                bins = fewer + [b for i, b in enumerate(full) if i not in taken]
                break
        else:
            return bins
    return bins


def _parts(useful: int, rng: random.Random):
    """(which of the full bins, times the effort) for each try."""
    for m in range(0, min(useful + REPACK_STEP, REPACK_GROWN), REPACK_STEP):
        yield range(min(m, useful)), 1
    k = 0
    while useful > REPACK_GROWN:
        m = min(useful, PICKED + k // PICKS * REPACK_STEP)
        yield rng.sample(range(min(useful, 4 * m)), m), 1 + k // PATIENCE
        k += 1


def pack_sizes(sizes: dict[int, int], capacity: int, effort: int = 2000) -> list[list[int]]:
    """Bins of items with the given sizes (size -> how many; 1 to capacity).

    Best-fit decreasing, then the same with its bins that are not full
    repacked among some others (``repacked``), then a branch-and-bound search
    of all bins (``searched``); the first that meets the lower bound stands.
    """
    best, bound = best_fit(sizes, capacity), least_bins(sizes, capacity)
    best = repacked(best, capacity, bound, effort)
    return best if len(best) <= bound else searched(best, capacity, effort)


def searched(best: list[list[int]], capacity: int, effort: int) -> list[list[int]]:
    """The bins ``best``, or fewer with the same items.

    Bin completion branch-and-bound: the largest free item opens a bin, its
    undominated fillings are the branches, fullest first, and a branch ends
    when the waste so far leaves no chance of fewer bins than the incumbent.
    The incumbent starts as ``best``. The search ends when the
    incumbent meets the lower bound, when there is no branch left, or after
    ``2 * effort`` steps for each bin of ``best``; then the
    incumbent stands, so every item is always packed. A step looks at one
    filling, or one size of a filling to be. Where the first filling is not
    found in ``effort`` steps, the best fit item by item is tried before it.
    """
    sizes = Counter(s for b in best for s in b)
    total, bound = sum(s * n for s, n in sizes.items()), least_bins(sizes, capacity)
    if len(best) <= bound:
        return best
    free = Sizes(sizes, capacity)
    stack: list[tuple[list[int], object]] = []  # (bin, its other fillings)
    waste, steps, limit = 0, 0, 2 * effort * len(best)

    def branches(room: int, spare: int):
        nonlocal steps
        found = Fillings(free, room)
        began, given = steps, None
        for filling in found.undominated(spare):
            steps += 1
            if steps >= limit:
                return
            if filling is not None:
                if filling != given:
                    yield filling
                began = limit
            elif steps - began >= effort:
                given, began = found.greedy(), limit
                yield given

    while True:
        spare = (len(best) - 1) * capacity - total  # all the waste a better solution may have
        if not free.there:
            if len(stack) < len(best):
                best = [b for b, _ in stack]
                if len(best) <= bound:
                    return best
            spare = -1
        big = None
        if spare >= waste and steps < limit:
            big = free.largest(capacity)
            free.take(big)
            choices = branches(capacity - big, min(spare - waste, capacity - big))
        while True:
            if big is None:
                if not stack or steps >= limit:
                    return best
                (big, *filling), choices = stack.pop()
                for s in filling:
                    free.put(s)
                waste -= capacity - big - sum(filling)
            steps += 1
            choice = next(choices, None)
            spare = (len(best) - 1) * capacity - total
            if choice is not None and waste + capacity - big - sum(choice) <= spare:
                for s in choice:
                    free.take(s)
                stack.append(([big, *choice], choices))
                waste += capacity - big - sum(choice)
                break
            free.put(big)
            big = None


def pack_pieces(pieces: DataFrame, capacity: int, length_col: str = "length", key: list[str] | None = None,
                group_rows: int = 6000) -> DataFrame:
    """All columns of ``pieces`` with ``sequence_id`` (long) and ``offset``
    (long): where each goes, gapless from 0, no sequence over ``capacity``.

    Pieces are dealt by a hash of ``key`` (default: all columns) into groups of about
    ``group_rows``, and each group is packed on its own, so at most one part
    of a sequence a group is lost against packing all at once. Repeated rows
    land in one group, which is solved on counts of sizes, whatever its
    length. A length that is null, below 1 or above the capacity raises.
    ``sequence_id`` is the group's number times 2**32 plus the sequence's.
    """
    src = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]).alias("_row"),
                        F.col(length_col).cast("long").alias("_len"),
                        F.xxhash64(*[F.col(f"`{c}`") for c in (key or pieces.columns)]).alias("_h"))
    groups = max(1, -(-pieces.count() // group_rows))
    # a number of partitions that AQE leaves as it is: the rows are few, the work on them is not
    src = src.withColumn("_g", F.pmod("_h", F.lit(groups))).repartition(2 * groups, "_g")

    def solve(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = table.sort_by([("_h", "ascending"), ("_len", "descending")])
        lengths = table.column("_len").to_numpy(zero_copy_only=False)
        if np.isnan(lengths.astype(float)).any() or (lengths < 1).any() or (lengths > capacity).any():
            raise ValueError(f"a piece is not between 1 and {capacity} tokens long")
        size, counts = np.unique(lengths, return_counts=True)
        waiting = {int(s): iter(np.flatnonzero(lengths == s).tolist()) for s in size}
        seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, bin_ in enumerate(pack_sizes(dict(zip(size.tolist(), counts.tolist())), capacity)):
            at = 0
            for s in bin_:
                i = next(waiting[s])
                seq[i], off[i] = k, at
                at += s
        seq += pc.max(table.column("_g")).as_py() << 32
        return pa.table({"_row": table.column("_row"), "sequence_id": pa.array(seq), "offset": pa.array(off)})

    row = src.schema["_row"].dataType.simpleString()
    out = src.groupBy("_g").applyInArrow(solve, f"_row {row}, sequence_id bigint, offset bigint")
    return out.select("_row.*", "sequence_id", "offset")


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document: its
    token ids and then ``end_id``. A document over ``capacity`` is cut into
    pieces of that length, of which the first may be shorter. ``ids`` are
    little-endian uint32 bytes. A null text is empty and so has one id.
    """
    def rows(b):
        for lo in range(0, b.num_rows, 250):
            run = b.slice(lo, 250)
            yield from zip(run.column(0).to_pylist(), [t or "" for t in run.column(1).to_pylist()])

    def cut(batches):
        import pyarrow as pa

        enc = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        width = 4 * capacity
        for b in batches:
            for run in by_bytes(rows(b), lambda r: len(r[1]), LOOKED_UP):
                cols: list[list] = [[], [], [], [], [], []]
                for (i, _), ids in zip(run, enc.encode([t for _, t in run])):
                    ids += end
                    cuts = [0, *range(len(ids) % width or width, len(ids) + 1, width)]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        part = ids[x:y]
                        for c, v in zip(cols, (i, k, x // 4, (y - x) // 4, zlib.crc32(part), part if keep_ids else None)):
                            c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [b.column(0).type, pa.int32(), pa.int64(), pa.int64(),
                                                           pa.int64(), pa.binary()])][:6 if keep_ids else 5],
                    [id_col, "piece", "start", "length", "ids_crc32", "ids"][:6 if keep_ids else 5])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents (``cut_pieces``) with their places
    (``pack_pieces``). Without ``keep_ids`` only numbers are shuffled.
    Repeated rows are documents of their own."""
    pieces = written(cut_pieces(docs, tokenizer, capacity, end_id, keep_ids, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity, key=[id_col, "piece", "ids_crc32"])


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, ids as
    little-endian uint32 bytes. A sequence has ``capacity`` pieces at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids_col).alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_p")) \
        .select("sequence_id", "n_tokens", F.expr("aggregate(_p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
