"""Operators that need a global order: distributed prefix scans and ranks.

An unpartitioned ``Window.orderBy`` moves every row into one task. The
helpers here instead run a parallel prefix scan:

1. ``repartitionByRange`` on the order key (Spark samples the key to pick
   balanced bounds, so a hot key value cannot pull a whole group into one
   task unless that single value dominates), sorted within partitions;
2. a reliable ``checkpoint`` into ``spark.checkpoint.dir`` pins the
   partition assignment so the partition id can be used twice;
3. one small aggregate per partition (as many rows as partitions) gives
   each partition its carry-in;
4. an Arrow-batched ``mapInPandas`` adds the carry to a partition-local
   cumulative op. No row leaves its partition; the driver only sees the
   per-partition totals, whose size is the partition count.

Callers that need per-group running totals use the global scan and
subtract the value at the group's start (an ordinary group aggregate),
so a hot group is spread over many partitions instead of one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import cut_lineage

_OPS = ("sum", "prod", "max", "min")


def _order_cols(order_by: Sequence) -> list[Column]:
    out = []
    for o in order_by:
        if isinstance(o, Column):
            out.append(o)
        elif isinstance(o, tuple):
            name, asc = o
            out.append(F.col(name).asc_nulls_first() if asc else F.col(name).desc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_first())
    return out


def ordered_scan(df: DataFrame, order_by: Sequence, specs: Mapping[str, tuple[str, str]],
                 num_partitions: int | None = None) -> DataFrame:
    """Inclusive running ``op`` of columns in the global order ``order_by``.

    ``specs`` maps output column -> (op, input column) with op in
    sum/prod/max/min. ``order_by`` items are names (ascending) or
    (name, ascending) tuples. Without ``num_partitions`` there are as many
    range partitions as the shuffle setting says, less those that AQE merges
    because the data is small. Rows tied on the whole order key are scanned
    in arbitrary order; aggregate to distinct keys first when that matters.
    """
    cols = _order_cols(order_by)
    ranged = df.repartitionByRange(*([num_partitions] if num_partitions else []), *cols).sortWithinPartitions(*cols)
    ck = cut_lineage(ranged)

    for out, (op, src) in specs.items():
        if op not in _OPS:
            raise ValueError(f"unsupported scan op {op}")
    aggs = []
    for out, (op, src) in specs.items():
        c = F.col(src)
        aggs.append({"sum": F.sum(c), "prod": F.product(c.cast("double")),
                     "max": F.max(c), "min": F.min(c)}[op].alias(out))
    # One row per non-empty partition: bounded by the partition count.
    totals = {r["_pid"]: r for r in ck.groupBy(F.spark_partition_id().alias("_pid")).agg(*aggs).collect()}
    carries: dict[int, dict[str, object]] = {}
    running: dict[str, object] = {k: None for k in specs}
    for pid in sorted(totals):  # partitions without rows have none to carry into
        carries[pid] = dict(running)
        for out, (op, _) in specs.items():
            v, prev = totals[pid][out], running[out]
            if v is None:
                continue
            if prev is None:
                running[out] = v
            elif op == "sum":
                running[out] = prev + v
            elif op == "prod":
                running[out] = prev * v
            elif op == "max":
                running[out] = max(prev, v)
            else:
                running[out] = min(prev, v)

    in_fields = {f.name: f.dataType for f in df.schema.fields}
    out_fields = list(df.schema.fields)
    for out, (op, src) in specs.items():
        dt = T.DoubleType() if op == "prod" or isinstance(in_fields[src], (T.FloatType, T.DecimalType)) \
            else in_fields[src]
        if op == "sum" and isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
            dt = T.LongType()
        out_fields.append(T.StructField(out, dt, True))
    schema = T.StructType(out_fields)
    spec_items = list(specs.items())

    def scan(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry = dict(carries.get(pid, {}))
        for pdf in batches:
            for out, (op, src) in spec_items:
                s = pdf[src]
                c = carry.get(out)
                # null inputs contribute nothing; the running value carries
                # through them (ffill), then the partition's carry-in is applied
                if op == "sum":
                    local = s.cumsum(skipna=True).ffill()
                    res = local.fillna(0) + c if c is not None else local
                elif op == "prod":
                    local = s.astype("float64").cumprod(skipna=True).ffill()
                    res = local.fillna(1.0) * c if c is not None else local
                elif op == "max":
                    local = s.cummax(skipna=True).ffill()
                    res = np.fmax(local, c) if c is not None else local
                else:
                    local = s.cummin(skipna=True).ffill()
                    res = np.fmin(local, c) if c is not None else local
                pdf[out] = res
                last = res.dropna()
                if len(last):
                    carry[out] = last.iloc[-1].item() if hasattr(last.iloc[-1], "item") else last.iloc[-1]
            yield pdf

    return ck.mapInPandas(scan, schema)


def group_offsets(df: DataFrame, group: Sequence[str], sums: Mapping[str, str],
                  num_partitions: int | None = None) -> DataFrame:
    """Per group, the total of each column over all earlier groups (in
    group order): the offset of the group's first row in a global scan over
    (group, ...). Computed on the small table of group totals, so the big
    scan is consumed once."""
    g = list(group)
    tot = df.groupBy(*g).agg(*[F.sum(i).alias(f"_t_{o}") for o, i in sums.items()])
    sc = ordered_scan(tot, g, {f"_u_{o}": ("sum", f"_t_{o}") for o in sums}, num_partitions)
    return sc.select(*g, *[(F.col(f"_u_{o}") - F.col(f"_t_{o}")).alias(o) for o in sums],
                     *[F.col(f"_t_{o}").alias(f"{o}_total") for o in sums])


def global_row_number(df: DataFrame, order_by: Sequence, out: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position in the global order (use a unique tie-break key)."""
    return ordered_scan(df.withColumn("_one", F.lit(1).cast("long")), order_by,
                        {out: ("sum", "_one")}, num_partitions).drop("_one")


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      qs: Mapping[str, float], num_partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group (numpy 'linear'). With
    ``weight`` a row stands for that many equal values.

    Values are first counted per (group, value), then a global prefix scan
    over (group, value) gives each distinct value its rank interval. No
    group is ever held in one task or buffer. Nulls are ignored.
    """
    g = list(group_cols)
    solo = not g
    if solo:  # one global group: a constant key keeps the same plan shape
        df, g = df.withColumn("_g", F.lit(0)), ["_g"]
    # written once: the scan and the group offsets both read it
    counts = cut_lineage(df.filter(F.col(value_col).isNotNull())
                           .groupBy(*g, value_col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c")))
    sc = ordered_scan(counts, g + [value_col], {"_cum": ("sum", "_c")}, num_partitions)
    sc = sc.withColumn("_end", F.col("_cum") - 1).withColumn("_start", F.col("_cum") - F.col("_c"))
    stats = group_offsets(counts, g, {"_base": "_c"}).withColumnRenamed("_base_total", "_n")
    j = sc.join(stats, g)
    aggs = []
    for name, q in qs.items():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        lo = F.floor(pos) + F.col("_base")
        hi = F.ceil(pos) + F.col("_base")
        in_lo = (F.col("_start") <= lo) & (lo <= F.col("_end"))
        in_hi = (F.col("_start") <= hi) & (hi <= F.col("_end"))
        j = j.withColumn(f"_lo_{name}", F.when(in_lo, F.col(value_col))) \
             .withColumn(f"_hi_{name}", F.when(in_hi, F.col(value_col))) \
             .withColumn(f"_fr_{name}", pos - F.floor(pos))
        aggs += [F.max(f"_lo_{name}").alias(f"_lo_{name}"), F.max(f"_hi_{name}").alias(f"_hi_{name}"),
                 F.max(f"_fr_{name}").alias(f"_fr_{name}")]
    r = j.groupBy(*g).agg(*aggs)
    outs = [(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_fr_{n}")).alias(n)
            for n in qs]
    r = r.select(*g, *outs)
    return r.drop("_g") if solo else r


def grouped_running(df: DataFrame, group: Sequence[str], order: Sequence, sums: Mapping[str, str],
                    exclusive: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Running sums per group in ``order`` without a per-group window.

    A global prefix scan over (group, order) gives cumulative totals; the
    group's own offset (the total before its first row) is a plain group
    aggregate subtracted afterwards. A group holding a third of all rows is
    therefore still scanned by many tasks. ``exclusive`` leaves the current
    row out (sum over rows strictly before it). ``sums`` maps output ->
    input column; the order key must be unique within a group.
    """
    g = list(group)
    specs = {f"_c_{o}": ("sum", i) for o, i in sums.items()}
    sc = ordered_scan(df, g + list(order), specs, num_partitions)
    incl = {o: F.col(f"_c_{o}") for o in sums}
    excl = {o: F.col(f"_c_{o}") - F.coalesce(F.col(i), F.lit(0)) for o, i in sums.items()}
    # offsets come from the written scan, so the input is evaluated once
    base = group_offsets(sc, g, {f"_b_{o}": i for o, i in sums.items()}).select(*g, *[f"_b_{o}" for o in sums])
    j = sc.join(base, g)
    vals = excl if exclusive else incl
    return j.withColumns({o: vals[o] - F.col(f"_b_{o}") for o in sums}) \
            .drop(*[f"_c_{o}" for o in sums], *[f"_b_{o}" for o in sums])
