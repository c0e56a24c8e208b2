"""Ordered per-key features: lags, rolling and exponential windows,
technical indicators, cross-sectional scores, buckets, last-n per key.

Everything is ``Window.partitionBy(key).orderBy(order)`` with explicit row
frames (``rowsBetween``) so "previous" means the previous row of the key,
as in the reference. ``min_periods`` is reproduced with a guarded
``count`` over the same frame. Cross-sectional statistics are a group
aggregate joined back rather than a window, so a hot date does not sort
inside one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import safe_divide
from quarry.session import stored


def _w(key, order) -> Window:
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    return Window.partitionBy(*keys).orderBy(*orders)


def lag_cols(df: DataFrame, key, order, cols: Sequence[str], ks: Sequence[int],
             fmt: str = "{c}_lag{k}") -> DataFrame:
    w = _w(key, order)
    return df.withColumns({fmt.format(c=c, k=k): F.lag(c, k).over(w) for c in cols for k in ks})


def rolling(x: Column | str, key, order, window: int, min_periods: int | None = None,
            agg: str = "avg", include_current: bool = True) -> Column:
    """Trailing ``agg`` over ``window`` rows, null until ``min_periods``
    non-null values are in the frame (pandas ``rolling`` semantics)."""
    x = F.col(x) if isinstance(x, str) else x
    lo, hi = (-(window - 1), 0) if include_current else (-window, -1)
    w = _w(key, order).rowsBetween(lo, hi)
    m = window if min_periods is None else min_periods
    fn = {"avg": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}[agg]
    return F.when(F.count(x).over(w) >= m, fn(x).over(w))


def log_return(price: str, key, order, k: int) -> Column:
    """ln(c / c[-k]); zero prices count as missing."""
    c = F.nullif(F.col(price), F.lit(0.0))
    return F.ln(safe_divide(c, F.lag(c, k).over(_w(key, order))))


def pct_change(price: str, key, order, k: int = 1) -> Column:
    c = F.col(price)
    return safe_divide(c, F.lag(c, k).over(_w(key, order))) - 1


def rest_days(date: str, key, order, first: int = 3, cap: int = 10) -> Column:
    d = F.datediff(F.col(date), F.lag(date, 1).over(_w(key, order)))
    return F.least(F.coalesce(d, F.lit(first)), F.lit(cap)).cast("double")


def rsi(price: str, key, order, period: int) -> Column:
    c = F.nullif(F.col(price), F.lit(0.0))
    delta = c - F.lag(c, 1).over(_w(key, order))
    gain = F.when(delta.isNull(), None).otherwise(F.greatest(delta, F.lit(0.0)))
    loss = F.when(delta.isNull(), None).otherwise(F.greatest(-delta, F.lit(0.0)))
    g = rolling(gain, key, order, period, period)
    lo = rolling(loss, key, order, period, period)
    rs = safe_divide(g, lo)
    return F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)



def exp_weighted_running_sum(df: DataFrame, v: Column, key, order, r: float, out: str,
                             index: str | None = None) -> DataFrame:
    """E_t = sum_{i<=t} r^(t-i) * v_i per key (nulls count as 0), any length.

    Rows are cut into blocks of B rows with r^-B <= e^300, so every weight
    inside a block stays finite. Within block b (first row a_b, offset
    j = t - a_b): E_t = r^j * C_t + r^(j+1) * E(a_b - 1), where C_t is the
    running sum of v_i * r^-(i - a_b) inside the block. E(a_b - 1) equals
    r^(B-1) * T_(b-1) (T = block total) up to a term scaled by r^B <= e^-300,
    which is below double precision, so only the previous block is needed.
    The block running sums are windows over (key, block), not over the key.
    ``index`` names a precomputed 0-based row position within the key (e.g.
    ``_idx`` from :func:`blocked` / the grouped prefix scan); without it a
    per-key row_number numbers the rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    B = max(1, int(300.0 / -math.log(r)))
    pos = F.col(index) if index else F.row_number().over(_w(key, order)) - 1
    d = df.withColumn("_ew_i", pos)
    d = d.withColumn("_ew_b", F.floor(F.col("_ew_i") / B)).withColumn("_ew_j", F.col("_ew_i") - F.col("_ew_b") * B)
    d = d.withColumn("_ew_u", F.coalesce(v, F.lit(0.0)) * F.pow(F.lit(r), -F.col("_ew_j")))
    wb = Window.partitionBy(*keys, "_ew_b").orderBy("_ew_i").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_ew_c", F.sum("_ew_u").over(wb))
    tot = d.groupBy(*keys, "_ew_b").agg(F.sum("_ew_u").alias("_ew_t")) \
        .select(*keys, (F.col("_ew_b") + 1).alias("_ew_b"), "_ew_t")
    d = d.join(tot, keys + ["_ew_b"], "left")
    prev = F.coalesce(F.pow(F.lit(r), F.lit(float(B - 1))) * F.col("_ew_t"), F.lit(0.0))
    e = F.pow(F.lit(r), F.col("_ew_j")) * F.col("_ew_c") + F.pow(F.lit(r), F.col("_ew_j") + 1) * prev
    return d.withColumn(out, e).drop("_ew_i", "_ew_b", "_ew_j", "_ew_u", "_ew_c", "_ew_t")


def ema(df: DataFrame, x: str, key, order, span: float, out: str, index: str | None = None) -> DataFrame:
    """pandas ``ewm(span, adjust=False).mean()``: y0 = x0, y = a*x + (1-a)*y[-1],
    i.e. y_t = sum_i w_i (1-a)^(t-i) x_i with w_0 = 1 and w_i = a after."""
    a = 2.0 / (span + 1.0)
    first = (F.col(index) == 0) if index else (F.row_number().over(_w(key, order)) == 1)
    v = F.when(first, F.col(x)).otherwise(F.lit(a) * F.col(x))
    return exp_weighted_running_sum(df, v, key, order, 1.0 - a, out, index)


def ewm_adjusted(df: DataFrame, x: str, key, order, span: float, min_periods: int, out: str,
                 index: str | None = None) -> DataFrame:
    """pandas ``ewm(span, min_periods).mean()`` (adjust=True): weights r^(t-i)
    over non-null values, positions counted including nulls. With ``index``
    the non-null count comes from the grouped prefix scan as well."""
    r = 1.0 - 2.0 / (span + 1.0)
    d = exp_weighted_running_sum(df, F.col(x), key, order, r, "_ewm_n", index)
    d = exp_weighted_running_sum(d, F.when(F.col(x).isNotNull(), F.lit(1.0)), key, order, r, "_ewm_d", index)
    if index:
        from quarry.operators.ordered import grouped_running
        keys = [key] if isinstance(key, str) else list(key)
        d = grouped_running(d.withColumn("_ewm_1", F.col(x).isNotNull().cast("long")), keys, [index],
                            {"_ewm_c": "_ewm_1"}, exclusive=False).drop("_ewm_1")
        n = F.col("_ewm_c")
    else:
        n = F.count(F.col(x)).over(_w(key, order).rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumn(out, F.when(n >= min_periods, F.col("_ewm_n") / F.col("_ewm_d"))) \
            .drop("_ewm_n", "_ewm_d", "_ewm_c")


def macd(df: DataFrame, price: str, key, order, fast=12, slow=26, signal=9, index: str | None = None) -> DataFrame:
    d = ema(df, price, key, order, fast, "_ema_f", index)
    d = ema(d, price, key, order, slow, "_ema_s", index)
    d = d.withColumn("macd_line", F.col("_ema_f") - F.col("_ema_s"))
    d = ema(d, "macd_line", key, order, signal, "macd_signal", index)
    d = d.withColumn("macd_hist", safe_divide(F.col("macd_line") - F.col("macd_signal"), F.col(price)))
    d = d.withColumn("macd_cross", (F.col("macd_line") > F.col("macd_signal")).cast("int"))
    return d.drop("_ema_f", "_ema_s")


def bollinger(price: str, key, order, period: int = 20) -> tuple[Column, Column]:
    c = F.nullif(F.col(price), F.lit(0.0))
    sma = rolling(c, key, order, period, period)
    sd = rolling(c, key, order, period, period, "std")
    upper, lower = sma + 2 * sd, sma - 2 * sd
    return safe_divide(c - lower, upper - lower), safe_divide(upper - lower, sma)


def atr(high: str, low: str, close: str, key, order, period: int = 14) -> Column:
    prev = F.lag(close, 1).over(_w(key, order))
    tr = F.greatest(F.col(high) - F.col(low), F.abs(F.col(high) - prev), F.abs(F.col(low) - prev))
    return safe_divide(rolling(tr, key, order, period, period), F.nullif(F.col(close), F.lit(0.0)))


def cross_section_zscore(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / sample sd within ``by`` (e.g. date); sd 0 -> null.
    Stats are a per-``by`` aggregate joined back (partial aggregation)."""
    stats = df.groupBy(by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                               *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols])
    j = df.join(stats, by)
    j = j.withColumns({c: safe_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in cols})
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def quantile_buckets(df: DataFrame, by: str, x: str, q: int = 10, out: str = "bucket") -> DataFrame:
    """pandas ``qcut(x, q, labels=False, duplicates='drop')`` within ``by``:
    linear quantile edges, duplicate edges dropped, right-closed bins, the
    minimum in bin 0. Edges come from the distributed exact percentiles."""
    from quarry.operators.ordered import exact_percentiles
    names = {f"_e{i}": i / q for i in range(q + 1)}
    edges = exact_percentiles(df, [by], x, names)
    arr = F.array_distinct(F.array(*[F.col(n) for n in names]))
    e = edges.select(by, arr.alias("_edges"))
    j = df.join(e, by)
    below = F.size(F.filter("_edges", lambda v: v < F.col(x)))
    return j.withColumn(out, F.when(F.col(x).isNotNull(), F.greatest(below - 1, F.lit(0)))).drop("_edges")


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  tiebreak: Sequence[str]) -> DataFrame:
    """First ``n`` rows per key in ``order`` (ties broken by ``tiebreak``).

    A rank below a constant is taken before the shuffle too (Spark's window
    group limit): each task sends ``n`` rows a key at most, so a key holding a
    third of all rows is cut down by the tasks that read it.
    """
    w = Window.partitionBy(*keys).orderBy(*order, *[F.col(t) for t in tiebreak])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)


def last_row_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order_cols`` via max_by on a struct: a plain
    aggregate with map-side partial aggregation, no sort of the key."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    r = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*[F.col(c) for c in order_cols])).alias("_last"))
    return r.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in others])


def group_mean_encode(df: DataFrame, key: str, y: str, out: str, fit_on: Column | None = None,
                      leave_one_out: bool = False, default: Column | float | None = None) -> DataFrame:
    """Mean of ``y`` per ``key`` attached to every row (target encoding).

    Fitted as a group aggregate on the rows selected by ``fit_on`` (the
    train split; all rows when None) and joined back, which is cheaper than
    a window on a hot key. The aggregate is stored first: with few keys the
    planner sees a small table and the rows are not shuffled by the key.
    ``leave_one_out`` removes the row's own label from its group mean on
    fitted rows: (sum - y) / (n - 1). Keys unseen in the fit get ``default``
    (the fitted global mean when None).
    """
    fit = df if fit_on is None else df.filter(fit_on)
    stats = stored(fit.groupBy(key).agg(F.sum(y).alias("_s"), F.count(F.lit(1)).alias("_n")), f"mean-by-{key}")
    glob = fit.agg(F.avg(y)).scalar() if default is None else (default if isinstance(default, Column)
                                                                 else F.lit(default))
    j = df.join(stats, key, "left")
    own = F.lit(True) if fit_on is None else fit_on
    plain = F.col("_s") / F.col("_n")
    loo = F.when(own & (F.col("_n") > 1), (F.col("_s") - F.col(y)) / (F.col("_n") - 1)).otherwise(plain)
    return j.withColumn(out, F.coalesce(loo if leave_one_out else plain, glob)).drop("_s", "_n")


def blocked(df: DataFrame, key, order, back: int, forward: int = 0, block_rows: int = 100_000) -> DataFrame:
    """Split every key into blocks of ``block_rows`` rows so that row-frame
    windows run per (key, block) instead of per key.

    Adds ``_idx`` (0-based row position in the key, from the grouped prefix
    scan: no per-key sort), ``_blk`` and ``_own``. The last ``back`` rows of
    a block are copied into the next block and the first ``forward`` rows
    into the previous one (``_own`` = false), so any window looking at most
    ``back`` rows behind and ``forward`` rows ahead is exact for owned rows.
    Use ``key=[*keys, "_blk"]`` and ``order="_idx"`` for the windows, then
    keep ``_own`` rows. A key holding a third of all rows is spread over
    many tasks.
    """
    from quarry.operators.ordered import grouped_running
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    if back >= block_rows or forward >= block_rows:
        raise ValueError("window reach must be smaller than the block")
    d = grouped_running(df.withColumn("_one", F.lit(1).cast("long")), keys, orders, {"_idx": "_one"})
    d = d.drop("_one")
    blk = F.floor(F.col("_idx") / block_rows)
    pos = F.col("_idx") - blk * block_rows
    copies = F.array(F.struct(blk.alias("b"), F.lit(True).alias("own")))
    copies = F.when(pos >= block_rows - back, F.array_union(copies, F.array(F.struct((blk + 1).alias("b"),
                                                                                      F.lit(False).alias("own"))))) \
              .otherwise(copies) if back > 0 else copies
    if forward > 0:
        copies = F.when((pos < forward) & (blk > 0),
                        F.array_union(copies, F.array(F.struct((blk - 1).alias("b"), F.lit(False).alias("own"))))) \
                  .otherwise(copies)
    d = d.select("*", F.explode(copies).alias("_c"))
    return d.select(*[c for c in d.columns if c != "_c"], F.col("_c.b").alias("_blk"), F.col("_c.own").alias("_own"))


def keyed_frame(df: DataFrame, key, order, back: int, forward: int = 0, block_rows: int = 100_000):
    """The frame for row-frame windows: ``(frame, keys, order, own)``.

    Always the blocked view (halo rows, positions from the grouped prefix
    scan), so a key of any length is spread over tasks and small data takes
    the same plan as large. Compute the windows over ``keys`` / ``order`` on
    ``frame``, then keep rows where ``own`` is true.
    """
    keys = [key] if isinstance(key, str) else list(key)
    b = blocked(df, keys, order, back, forward, block_rows)
    return b, keys + ["_blk"], ["_idx"], F.col("_own")


def row_index(df: DataFrame, key, order) -> tuple[DataFrame, str]:
    """Row numbering for the exponential windows: a 0-based ``_ix`` column
    from the grouped prefix scan, so no window is keyed on the key alone."""
    keys = [key] if isinstance(key, str) else list(key)
    from quarry.operators.ordered import grouped_running
    orders = [order] if isinstance(order, (str, Column)) else list(order)
    d = grouped_running(df.withColumn("_one", F.lit(1).cast("long")), keys, orders, {"_ix": "_one"})
    return d.drop("_one"), "_ix"
