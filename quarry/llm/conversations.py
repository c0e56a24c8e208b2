"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation is a sequence of rows; a row is one of nine symbols (must go,
or the role's initial and whether the text is cut off). What the edits of a
run of symbols cost from one state of the role automaton to another is a
min-plus matrix, with the edits' initials as a rope beside each cost. Equal
runs have equal matrices, so the sequences of all conversations are
compressed by one grammar (Re-Pair: frequent neighbours become a symbol, again
and again), one matrix is made a rule, bottom-up, and a conversation is the
product of the few symbols left of it.

Sequences are handled in chunks of ``CHUNK`` rows and only different ones are
compressed and solved. A conversation of many chunks chains their matrices, so
no task ever holds the rows of a long one. Edits are compared by cost, then as
text; two runs of edits over the same rows are never one the other's prefix,
so comparing them chunk by chunk is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import WHITE, shuffle_partitions, written

#: Rows of a conversation in one chunk at most.
CHUNK = 65_536
#: Rules of the grammar at most, and new ones a round; what is left uncompressed is multiplied symbol by symbol.
MAX_RULES, ROUND_RULES = 4_096, 1_024

#: States of ``(s?(ua)+)?``: at the start, after the s, after a u, after an a.
STATES = 4
#: state -> {initial: next state}
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: Edits that end a conversation well from each state.
TAILS = ("", "II", "I", "")
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: Symbols: 0 must go; else 1 + 2 * (place of the initial here) + (1 if cut off).
INITIALS = "sua?"
TERMINALS = 1 + 2 * len(INITIALS)

Matrix = list  # STATES * STATES of None or (cost, rope)


class Ropes:
    """Strings made of shared parts: a rope is an index, of a piece of text or of two ropes."""

    def __init__(self, parts: list | None = None):
        self.parts: list = parts if parts is not None else []

    def leaf(self, s: str) -> int:
        self.parts.append(s)
        return len(self.parts) - 1

    def join(self, a: int, b: int) -> int:
        self.parts.append((a, b))
        return len(self.parts) - 1

    def less(self, a: int, b: int) -> bool:
        """Whether rope ``a`` comes before ``b`` as text; common parts are skipped."""
        parts, left, right = self.parts, [a], [b]
        while left and right:
            x, y = left.pop(), right.pop()
            if x == y:
                continue
            s = parts[x] if isinstance(x, int) else x
            t = parts[y] if isinstance(y, int) else y
            if isinstance(s, tuple):
                left += [s[1], s[0]]
                right.append(y)
            elif isinstance(t, tuple):
                right += [t[1], t[0]]
                left.append(x)
            else:
                k = min(len(s), len(t))
                if s[:k] != t[:k]:
                    return s[:k] < t[:k]
                if s[k:]:
                    left.append(s[k:])
                if t[k:]:
                    right.append(t[k:])
        return not left and bool(right)

    def text(self, a: int) -> str:
        out, todo = [], [a]
        while todo:
            s = self.parts[todo.pop()]
            if isinstance(s, tuple):
                todo += [s[1], s[0]]
            else:
                out.append(s)
        return "".join(out)

    def product(self, a: Matrix, b: Matrix) -> Matrix:
        """Min-plus product; of equal costs the rope that comes first."""
        out: Matrix = [None] * (STATES * STATES)
        for p in range(STATES):
            for q in range(STATES):
                best = None
                for m in range(STATES):
                    x, y = a[p * STATES + m], b[m * STATES + q]
                    if x is None or y is None:
                        continue
                    cost = x[0] + y[0]
                    if best is None or cost < best[0]:
                        best = (cost, self.join(x[1], y[1]))
                    elif cost == best[0]:
                        rope = self.join(x[1], y[1])
                        if self.less(rope, best[1]):
                            best = (cost, rope)
                out[p * STATES + q] = best
        return out

    def terminal(self, symbol: int) -> Matrix:
        """Inserts before a row, then the row's edit."""
        best: dict[int, tuple[int, str]] = {}

        def offer(p, q, cost, text):
            at = p * STATES + q
            best[at] = min(best.get(at, (cost, text)), (cost, text))

        for p in range(STATES):
            state, inserted = p, 0
            while inserted <= 2:  # a third insert leads to a state seen before
                cost, text = INSERT * inserted, "I" * inserted
                offer(p, state, cost + DELETE, text + "D")
                if symbol:
                    kind, cut_off = divmod(symbol - 1, 2)
                    for initial, q in NEXT[state].items():
                        if initial == INITIALS[kind]:
                            offer(p, q, cost + CUT_OFF * cut_off, text + "K")
                        if initial in ROLES:
                            offer(p, q, cost + REROLE + CUT_OFF * cut_off, text + "R")
                state = NEXT[state].get("u", NEXT[state].get("a"))
                inserted += 1
        return [(best[at][0], self.leaf(best[at][1])) if at in best else None for at in range(STATES * STATES)]

    def whole(self, m: Matrix) -> tuple[int, str]:
        """(cost, edits) of a whole conversation with this matrix."""
        return min((m[q][0] + INSERT * len(TAILS[q]), self.text(m[q][1]) + TAILS[q]) for q in range(STATES) if m[q])


def evaluated(rules: list[tuple[int, int]]) -> tuple[list[Matrix], list]:
    """(matrix of each terminal and rule, the parts of their ropes), bottom-up."""
    ropes = Ropes()
    made = [ropes.terminal(s) for s in range(TERMINALS)]
    for a, b in rules:
        made.append(ropes.product(made[a], made[b]))
    return made, ropes.parts


# ---- Re-Pair ---------------------------------------------------------------

def _sequences(col) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all rows with -1 after each row, row of each place)."""
    parts = [np.frombuffer(x, "<i4") for x in col.to_pylist()]
    size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    flat = np.full(int(size.sum()), -1, np.int64)
    row = np.repeat(np.arange(len(parts)), size)
    keep = np.ones(len(flat), bool)
    keep[np.cumsum(size) - 1] = False
    if len(parts):
        flat[keep] = np.concatenate(parts)
    return flat, row


def pair_counts(seqs: DataFrame) -> DataFrame:
    """(pair, uses): neighbours in all sequences, as often as the sequences occur."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            flat, row = _sequences(b.column("sym"))
            n = b.column("n").to_numpy(zero_copy_only=False)
            at = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
            kinds, inverse = np.unique((flat[at] << 32) | flat[at + 1], return_inverse=True)
            uses = np.zeros(len(kinds), np.int64)
            np.add.at(uses, inverse, n[row[at]])
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(uses)], ["pair", "uses"])

    return seqs.select("sym", "n").mapInArrow(run, "pair bigint, uses bigint").groupBy("pair").agg(F.sum("uses").alias("uses"))


def replaced(flat: np.ndarray, rules: dict[tuple[int, int], int]) -> np.ndarray:
    """Which places (True) go, after new symbols were put into ``flat`` in
    place. No symbol is both a first and a second of the pairs, so only a
    pair of equal symbols overlaps itself; its runs are taken from the left."""
    keys = np.array(sorted((a << 32) | b for a, b in rules), np.int64)
    new = np.array([rules[int(k) >> 32, int(k) & 0xFFFFFFFF] for k in keys], np.int64)
    key = np.where((flat[:-1] >= 0) & (flat[1:] >= 0), (flat[:-1] << 32) | flat[1:], -1)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    same = hit & (flat[:-1] == flat[1:])
    if same.any():
        place = np.arange(len(flat))
        start = np.maximum.accumulate(np.where(np.concatenate([[True], flat[1:] != flat[:-1]]), place, 0))
        hit &= ~same | ((place - start)[:-1] % 2 == 0)
    i = np.flatnonzero(hit)
    flat[i] = new[at[i]]
    gone = np.zeros(len(flat), bool)
    gone[i + 1] = True
    return gone


def chosen(pairs: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """Pairs, most used first, of which no symbol is both a first and a second."""
    firsts, seconds, twins, out = set(), set(), set(), []
    for a, b in pairs:
        if len(out) == room:
            break
        if a == b:
            if a in firsts or a in seconds:
                continue
            twins.add(a)
        else:
            if a in seconds or a in twins or b in firsts or b in twins:
                continue
            firsts.add(a)
            seconds.add(b)
        out.append((a, b))
    return out


def re_pair(seqs: DataFrame, max_rules: int = MAX_RULES) -> tuple[list[tuple[int, int]], DataFrame]:
    """(rules, ``seqs`` with ``sym`` compressed). A round replaces the most
    used pairs that do not overlap; it ends when no pair is used twice, the
    rules are full, or a round would shorten what is left by under 2 %. The
    driver holds the rules alone."""
    rules: list[tuple[int, int]] = []
    size = None
    while len(rules) < max_rules:
        top = pair_counts(seqs).where("uses > 1").orderBy(F.desc("uses"), "pair").limit(ROUND_RULES).collect()
        pairs = chosen([(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF) for r in top], max_rules - len(rules))
        uses = {(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF): r["uses"] for r in top}
        if size is None:
            size = seqs.agg(F.sum(F.octet_length("sym") / 4 * F.col("n"))).first()[0]
        saved = sum(uses[p] for p in pairs)
        if not pairs or saved < 0.02 * size:
            break
        size -= saved
        new = {p: TERMINALS + len(rules) + k for k, p in enumerate(pairs)}
        rules += pairs

        def run(batches, new=new):
            import pyarrow as pa

            for b in batches:
                flat, row = _sequences(b.column("sym"))
                keep = ~replaced(flat, new) & (flat >= 0) if len(flat) else np.zeros(0, bool)
                ends = np.cumsum(np.bincount(row[keep], minlength=b.num_rows))
                got = [x.astype("<i4").tobytes() for x in np.split(flat[keep], ends[:-1])] if b.num_rows else []
                yield pa.RecordBatch.from_arrays([b.column("seq"), b.column("n"), b.column("many"), pa.array(got, pa.binary())],
                                                 ["seq", "n", "many", "sym"])

        seqs = written(seqs.select("seq", "n", "many", "sym").mapInArrow(run, "seq binary, n bigint, many boolean, sym binary"), "sequences")
    return rules, seqs


# ---- rows, chunks, chains --------------------------------------------------

def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` (_conv, _turn, _role, _text, _rid, _digest) with ``_fault``:
    0 none, 1 blank, 2 duplicate, 3 truncated (the first that holds)."""
    end = F.rtrim("_text", F.lit(WHITE))
    first = rows.groupBy("_conv", "_digest").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_turn", "_rid"))["_rid"].alias("_first")) \
        .where("_n > 1").select(F.col("_conv").alias("_c"), F.col("_digest").alias("_d"), "_first")
    return rows.select("_conv", "_turn", "_digest", "_rid", F.substring("_role", 1, 1).alias("_initial"), (end == "").alias("_blank"),
                       (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("_open")) \
        .join(first, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_digest") == F.col("_d")), "left") \
        .withColumn("_fault", F.when(F.col("_blank"), 1).when(F.col("_first") != F.col("_rid"), 2).when(F.col("_open"), 3).otherwise(0))


def chunks_of(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(_conv, _chunk, seq, and what the chunk adds to the counts) in order
    of ``_chunk`` within a conversation. Rows are sorted in ranges, so a long
    conversation lies in several tasks."""
    order = [F.col("_conv").asc_nulls_first(), F.col("_turn").asc_nulls_first(), F.col("_digest").asc(), F.col("_rid").asc()]
    code = F.coalesce(*[F.when(F.col("_initial") == c, F.lit(k)) for k, c in enumerate(INITIALS[:-1])], F.lit(len(INITIALS) - 1))
    src = faulted(rows).select("_conv", "_turn", "_digest", "_rid", code.cast("int").alias("_kind"), F.col("_fault").cast("int").alias("_fault"))
    src = src.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order).select("_conv", "_turn", "_kind", "_fault")
    conv_type = rows.schema["_conv"].dataType
    longs = ["n", "blank", "duplicate", "truncated", "illegal", "turns", "least", "most", "first_turn", "last_turn"]
    schema = T.StructType([T.StructField("_conv", conv_type), T.StructField("_chunk", T.LongType()), T.StructField("seq", T.BinaryType()),
                           *[T.StructField(c, T.LongType()) for c in longs],
                           T.StructField("first_kind", T.IntegerType()), T.StructField("last_kind", T.IntegerType())])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 33
        legal = np.zeros((4, 4), bool)
        legal[0, 1] = legal[1, 2] = legal[2, 1] = True
        held: list = []  # parts (turn, has turn, kind, fault) of the open chunk
        size, open_conv = 0, None

        def out():
            nonlocal at
            turn, has, kind, fault = (np.concatenate(x) for x in zip(*held))
            seq = np.where((fault == 1) | (fault == 2), 0, 1 + 2 * kind + (fault == 3)).astype(np.uint8)
            t = turn[has]
            row = [open_conv, at, seq.tobytes(), len(kind), *(int((fault == k).sum()) for k in (1, 2, 3)),
                   int((~legal[kind[:-1], kind[1:]]).sum()), int((t[1:] != t[:-1]).sum()) + 1 if len(t) else 0,
                   *((int(t[0]), int(t[-1])) if len(t) else (None, None)),
                   int(turn[0]) if has[0] else None, int(turn[-1]) if has[-1] else None, int(kind[0]), int(kind[-1])]
            at += 1
            held.clear()
            return row

        for b in batches:
            conv = b.column(0).dictionary_encode()
            code = conv.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            names = conv.dictionary.to_pylist()
            has = b.column(1).is_valid().to_numpy(zero_copy_only=False)
            turn = b.column(1).fill_null(0).to_numpy(zero_copy_only=False)
            kind, fault = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
            rows_out = []
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                name = None if code[i] < 0 else names[code[i]]
                if held and name != open_conv:
                    rows_out.append(out())
                    size = 0
                open_conv = name
                while i < j:
                    k = min(j, i + chunk - size)
                    held.append((turn[i:k], has[i:k], kind[i:k], fault[i:k]))
                    size += k - i
                    i = k
                    if size == chunk:
                        rows_out.append(out())
                        size = 0
            if rows_out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(zip(*rows_out), types(b))], schema.names)
            last = b
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], f) for c, f in zip(out(), types(last))], schema.names)

    def types(b):
        import pyarrow as pa

        return [b.column(0).type, pa.int64(), pa.binary(), *[pa.int64()] * len(longs), pa.int32(), pa.int32()]

    return src.mapInArrow(run, schema)


def solved(seqs: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """(seq, cost, audit) of each different sequence as a whole conversation;
    for one that is a chunk among ``many`` also ``costs``, ``places`` (order of
    the edits as text) and ``audits`` from each state to each state."""
    spark = seqs.sparkSession
    shared = spark.sparkContext.broadcast(evaluated(rules))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            cost, audit, costs, places, audits = [], [], [], [], []
            for sym, many in zip(b.column("sym").to_pylist(), b.column("many").to_pylist()):
                made, parts = shared.value
                ropes = Ropes(parts)
                known = len(parts)
                m = None
                for s in np.frombuffer(sym, "<i4").tolist():
                    m = made[s] if m is None else ropes.product(m, made[s])
                c, a = ropes.whole(m)
                cost.append(c)
                audit.append(a)
                if many:
                    texts = [None if x is None else ropes.text(x[1]) for x in m]
                    order = sorted({t for t in texts if t is not None})
                    costs.append([None if x is None else x[0] for x in m])
                    places.append([None if t is None else order.index(t) for t in texts])
                    audits.append(texts)
                else:
                    for x in (costs, places, audits):
                        x.append(None)
                del parts[known:]  # what this sequence alone has joined
            yield pa.RecordBatch.from_arrays(
                [b.column("seq"), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(costs, pa.list_(pa.int64())),
                 pa.array(places, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
                ["seq", "cost", "audit", "costs", "places", "audits"])

    return seqs.select("seq", "many", "sym").mapInArrow(
        run, "seq binary, cost bigint, audit string, costs array<bigint>, places array<int>, audits array<string>")


def chained(chunks: list[tuple[list, list]]) -> tuple[int, list[int]]:
    """(cost, place in the matrix of each chunk) of the cheapest way through
    the chunks' (costs, places), of equal ways the one whose edits come first."""
    now: dict[int, tuple[int, int]] = {0: (0, 0)}  # state -> (cost, order among the ways here)
    back: list[dict[int, int]] = []
    for costs, places in chunks:
        best: dict[int, tuple] = {}
        for p, (cost, order) in now.items():
            for q in range(STATES):
                k = p * STATES + q
                if costs[k] is not None:
                    best[q] = min(best.get(q, (cost + costs[k], order, places[k], p)), (cost + costs[k], order, places[k], p))
        ways = sorted({(order, place) for _, order, place, _ in best.values()})
        now = {q: (cost, ways.index((order, place))) for q, (cost, order, place, _) in best.items()}
        back.append({q: p for q, (_, _, _, p) in best.items()})
    # tails never decide between ways that differ: neither is the other's prefix
    total, _, q = min((cost + INSERT * len(TAILS[q]), order, q) for q, (cost, order) in now.items())
    at = []
    for step in reversed(back):
        at.append(step[q] * STATES + q)
        q = step[q]
    return total, at[::-1]


def chains(chunks: DataFrame) -> DataFrame:
    """(_chunk, _at, _tail, _total) of conversations of many chunks: a few
    numbers a chunk, so that a group is a conversation's rows / ``CHUNK``."""
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        # pandas makes missing numbers NaN
        lists = [([None if x is None or x != x else int(x) for x in c], [None if x is None or x != x else int(x) for x in p])
                 for c, p in zip(pdf["costs"], pdf["places"])]
        total, at = chained(lists)
        tail = [""] * (len(at) - 1) + [TAILS[at[-1] % STATES]]
        return pd.DataFrame({"_chunk": pdf["_chunk"].to_numpy(), "_at": at, "_tail": tail, "_total": total})

    return chunks.select("_conv", "_chunk", "costs", "places").groupBy("_conv") \
        .applyInPandas(run, "_chunk bigint, _at int, _tail string, _total bigint")


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", chunk: int = CHUNK, max_rules: int = MAX_RULES) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows).

    The report has a row for each conversation: ``gaps`` (missing turn
    numbers), ``blank``, ``duplicate``, ``truncated`` (rows by their first
    fault), ``illegal`` (neighbours whose role initials are not su, ua or au),
    ``cost`` and ``audit``: the initials of the cheapest edits (Keep, Rerole,
    Delete, Insert) after which the role initials read ``(s?(ua)+)?``. The
    repaired rows are (conv, place, edit, role, text) without the deleted,
    each conversation's in order within one partition; one that is deleted
    whole has none.

    Rows go by turn, nulls first, then by the SHA-256 of role and text; equal
    rows are duplicates of one another. Null roles and texts count as one
    space, null ids are one conversation, a role counts by its first
    character. A null turn is a row like others but no turn number. An empty
    table gives no rows. Other columns are ignored.
    """
    blank = F.lit(" ")
    role, text = F.coalesce(F.col(role_col).cast("string"), blank), F.coalesce(F.col(text_col).cast("string"), blank)
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = written(conversations.select(F.col(conv_col).alias("_conv"), F.col(turn_col).cast("long").alias("_turn"), role.alias("_role"),
                                        text.alias("_text"), F.monotonically_increasing_id().alias("_rid"), digest.alias("_digest")), "turns")
    chunks = written(chunks_of(rows, chunk), "chunks")
    by = Window.partitionBy("_conv").orderBy("_chunk")
    marked = chunks.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("_conv")) > 1) \
        .withColumn("_kind", F.lag("last_kind").over(by)).withColumn("_turn", F.lag("last_turn").over(by))
    marked = written(marked, "marked")
    seqs = marked.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.max("many").alias("many"))

    def widened(batches):
        import pyarrow as pa

        for b in batches:
            sym = [np.frombuffer(x, np.uint8).astype("<i4").tobytes() for x in b.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sym, pa.binary())], ["seq", "n", "many", "sym"])

    seqs = written(seqs.mapInArrow(widened, "seq binary, n bigint, many boolean, sym binary"), "sequences")
    rules, seqs = re_pair(seqs, max_rules)
    answers = written(solved(seqs, rules), "answers")

    one = marked.where("not many").join(answers, "seq").select("_conv", "_chunk", F.col("audit").alias("_piece"), F.col("cost").alias("_cost"))
    more = marked.where("many").select("_conv", "_chunk", "seq").join(answers.select("seq", "costs", "places", "audits"), "seq")
    more = more.join(chains(more), "_chunk").select(
        "_conv", "_chunk", F.concat(F.element_at("audits", F.col("_at") + 1), "_tail").alias("_piece"), F.col("_total").alias("_cost"))
    pieces = written(one.unionByName(more), "pieces")

    legal = F.concat_ws("", "_kind", "first_kind").isin("01", "12", "21")
    counts = marked.groupBy("_conv").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.when(F.col("_kind").isNotNull() & ~legal, 1).otherwise(0)).alias("illegal"),
        F.coalesce(F.max("most") - F.min("least") + 1
                   - F.sum(F.col("turns") - F.when(F.col("_turn") == F.col("first_turn"), 1).otherwise(0)), F.lit(0)).alias("gaps"))
    audits = pieces.groupBy(F.col("_conv").alias("_c")).agg(
        F.max("_cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_chunk", "_piece"))), lambda x: x["_piece"]), "").alias("audit"))
    report = counts.join(audits, F.col("_conv").eqNullSafe(F.col("_c"))) \
        .select(F.col("_conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return report, repaired(rows, pieces, conv_col)


def repaired(rows: DataFrame, pieces: DataFrame, conv_col: str) -> DataFrame:
    """The edits done. Edits and rows of a conversation meet in one sorted
    stream, edits first; a task holds the edits' initials of one conversation
    and a batch of rows."""
    null = F.lit(None)
    stream = rows.select("_conv", F.lit(1).alias("_part"), "_turn", "_digest", "_rid", "_role", "_text").unionByName(
        pieces.select("_conv", F.lit(0).alias("_part"), null.cast("long").alias("_turn"), null.cast("binary").alias("_digest"),
                      F.col("_chunk").alias("_rid"), null.cast("string").alias("_role"), F.col("_piece").alias("_text")))
    stream = stream.repartition(shuffle_partitions(rows.sparkSession), "_conv") \
        .sortWithinPartitions(F.col("_conv").asc_nulls_first(), "_part", F.col("_turn").asc_nulls_first(), "_digest", "_rid") \
        .select("_conv", "_part", "_role", "_text")
    schema = T.StructType([T.StructField(conv_col, rows.schema["_conv"].dataType), T.StructField("place", T.LongType()),
                           T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa

        conv, audit, at, state, place, begun = None, [], 0, 0, 0, False
        out: list[tuple] = []

        def put(edit, role, text):
            nonlocal place, state
            state = NEXT[state][role[0]]
            out.append((conv, place, edit, role, text))
            place += 1

        def inserts():
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put("I", "assistant" if state == 2 else "user", "")
                at += 1

        kind = None
        for b in batches:
            kind = b.column(0).type
            for c, part, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if not begun or c != conv or part == 0 and at:
                    inserts()  # those at the end of the conversation before
                    conv, audit, at, state, place, begun = c, "", 0, 0, 0, True
                if part == 0:
                    audit += text
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put(edit, role, text)
                elif edit == "R":
                    put(edit, "assistant" if state == 2 else "user", text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                    kind, pa.int64(), pa.string(), pa.string(), pa.string()))], schema.names)
                out = []
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                kind, pa.int64(), pa.string(), pa.string(), pa.string()))], schema.names)

    return stream.mapInArrow(run, schema)


def conversation_hashes(repaired_rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, repaired_sha256): SHA-256 of ``role:text`` of the repaired rows,
    joined by line feeds. Rows stream through the hash in the order that
    ``repaired`` left them in; none is held."""
    schema = T.StructType([T.StructField(conv_col, repaired_rows.schema[conv_col].dataType), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        import pyarrow as pa

        conv, state, done, kind = None, None, [], None
        for b in batches:
            kind = b.column(0).type
            for c, role, text in zip(*(x.to_pylist() for x in b.columns)):
                line = f"{role}:{text}".encode()
                if state is not None and c == conv:
                    state.update(b"\n" + line)
                    continue
                if state is not None:
                    done.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256(line)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (kind, pa.string()))], schema.names)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], schema.names)

    return repaired_rows.select(conv_col, "role", "text").mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the CRC-32 of
    ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its sentence ends, 3 repeats it, 4 makes it the user's. Nulls count as one
    space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    text = F.coalesce("text", blank)
    return conversations.withColumn("_k", F.crc32(key.cast("binary")) % 20).where("_k <> 0").select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
