"""Grouped aggregates: rates, shares, pivots, RFM, cohorts, concentration.

All are ``groupBy().agg()`` compositions (partial aggregation happens
map-side before the shuffle). Totals used as denominators are scalar
subqueries over the *aggregated* result, never a raw-row window.
Anything needing a global order (Gini, top shares, medians) goes through
the prefix scan in :mod:`quarry.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import safe_divide
from quarry.session import cut_lineage
from quarry.operators.ordered import exact_percentiles, ordered_scan


def group_rate_stats(df: DataFrame, keys: Sequence[str], flag: str, score: str | None = None,
                     rate_name: str = "ontime_rate", invert: bool = True) -> DataFrame:
    """Per group: (1 -) mean(flag), mean(score), count."""
    rate = F.avg(flag)
    aggs = [(F.lit(1.0) - rate if invert else rate).alias(rate_name)]
    if score:
        aggs.append(F.avg(score).alias(f"avg_{score}"))
    aggs.append(F.count(F.lit(1)).alias("n"))
    return df.groupBy(*keys).agg(*aggs)


def group_having(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], min_count: int,
                 count_name: str = "n") -> DataFrame:
    """Aggregate then keep groups with at least ``min_count`` rows."""
    return (df.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias(count_name))
              .filter(F.col(count_name) >= min_count))


def mean_of_means(df: DataFrame, inner_keys: Sequence[str], outer_keys: Sequence[str],
                  value: str, out: str = "mean_rate") -> DataFrame:
    """Unweighted mean over inner groups (e.g. monthly rates averaged by month)."""
    inner = df.groupBy(*inner_keys).agg(F.avg(value).alias("_m"))
    return inner.groupBy(*outer_keys).agg(F.avg("_m").alias(out))


def share_of_total(agg: DataFrame, value: str, out: str = "share", scale: float = 100.0) -> DataFrame:
    """Divide an aggregated value by its grand total (scalar subquery)."""
    total = agg.agg(F.sum(value)).scalar()
    return agg.withColumn(out, safe_divide(F.col(value) * F.lit(scale), total))


def pivot_sum(df: DataFrame, row: str, col: str, value: str, values: Sequence, fill=0.0,
              names: Sequence[str] | None = None) -> DataFrame:
    """row x fixed column values, absent cells -> ``fill``. Conditional sums
    keep it to one aggregate (no pivot discovery job)."""
    names = names or [str(v) for v in values]
    aggs = [F.coalesce(F.sum(F.when(F.col(col) == F.lit(v), F.col(value))), F.lit(fill)).alias(n)
            for v, n in zip(values, names)]
    return df.groupBy(row).agg(*aggs)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float]) -> DataFrame:
    """Exact per-group percentiles (linear interpolation) via the prefix scan."""
    return exact_percentiles(df, keys, value, qs)


def two_level_distribution(df: DataFrame, entity: str, value: str, qs: Mapping[str, float]) -> DataFrame:
    """Sum per entity, then global percentiles + mean of those sums."""
    per = df.groupBy(entity).agg(F.sum(value).alias("_total"))
    q = exact_percentiles(per, [], "_total", qs)
    return q.withColumn("mean", per.agg(F.avg("_total")).scalar())


def rfm(visits: DataFrame, entity: str, date: str, amount: str, snapshot) -> DataFrame:
    """recency (days since last), frequency (count), monetary (sum)."""
    return visits.groupBy(entity).agg(
        F.datediff(snapshot, F.max(date)).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(amount).alias("monetary"))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini over abs(value): (2 sum i*x_i)/(n sum x) - (n+1)/n, ascending.

    Ties do not change sum i*x_i, so values are counted per distinct value
    and ranks come from a prefix scan over distinct values.
    """
    v = df.select(F.abs(F.col(value)).alias("_x")).filter(F.col("_x").isNotNull())
    cnt = v.groupBy("_x").agg(F.count(F.lit(1)).alias("_c"))
    sc = ordered_scan(cnt, ["_x"], {"_cum": ("sum", "_c")})
    # ranks (1-based) of the tied run: start = cum - c + 1 ... end = cum
    rank_sum = (F.col("_cum") - F.col("_c") + 1 + F.col("_cum")) * F.col("_c") / 2.0
    s = sc.agg(F.sum(rank_sum * F.col("_x")).alias("_ix"), F.sum(F.col("_x") * F.col("_c")).alias("_sx"),
               F.sum("_c").alias("_n"))
    return s.select((F.lit(2.0) * F.col("_ix") / (F.col("_n") * F.col("_sx"))
                     - (F.col("_n") + 1) / F.col("_n")).alias("gini"))


def top_share(df: DataFrame, value: str, fractions: Mapping[str, float]) -> DataFrame:
    """Share of the total held by the top max(1, n*f) rows (n // (1/f)).

    Distinct values are scanned in descending order; the boundary value
    contributes only the rows needed to reach k.
    """
    v = df.select(F.col(value).alias("_x")).filter(F.col("_x").isNotNull())
    cnt = cut_lineage(v.groupBy("_x").agg(F.count(F.lit(1)).alias("_c")))  # the scan and both totals read it
    sc = ordered_scan(cnt, [("_x", False)], {"_cum": ("sum", "_c")})
    n = cnt.agg(F.sum("_c")).scalar()
    total = cnt.agg(F.sum(F.col("_x") * F.col("_c"))).scalar()
    aggs = []
    for name, f in fractions.items():
        k = F.greatest(F.floor(n / F.lit(int(round(1 / f)))), F.lit(1))
        taken = F.least(F.col("_c"), F.greatest(k - (F.col("_cum") - F.col("_c")), F.lit(0)))
        aggs.append((F.sum(taken * F.col("_x")) / total).alias(name))
    return sc.agg(*aggs)


def cohort_retention(visits: DataFrame, entity: str, date: str, offsets_months: Sequence[int],
                     window_months: int = 1, attended: str | None = None) -> DataFrame:
    """Quarter cohorts of first visit; for each offset m, the share of the
    cohort with an (attended) visit in [start+m-w, start+m+w] months where
    start is the cohort's earliest first visit.

    The (cohort x offset) window table is tiny and fixed by the calendar,
    so the range condition becomes a join on cohort plus a residual filter.
    """
    first = visits.groupBy(entity).agg(F.min(date).alias("_first"))
    first = first.withColumn("cohort", F.concat(F.year("_first").cast("string"), F.lit("Q"),
                                                F.quarter("_first").cast("string")))
    cohorts = first.groupBy("cohort").agg(F.min("_first").alias("_start"),
                                          F.count(F.lit(1)).alias("cohort_size"))
    wins = cohorts.select("cohort", "_start", "cohort_size",
                          F.explode(F.array(*[F.lit(int(m)) for m in offsets_months])).alias("offset"))
    wins = wins.withColumn("_lo", F.add_months("_start", F.col("offset") - window_months)) \
               .withColumn("_hi", F.add_months("_start", F.col("offset") + window_months))
    v = visits if attended is None else visits.filter(F.col(attended) == 1)
    v = v.select(entity, date).join(first.select(entity, "cohort"), entity)
    # wins has (#quarters x #offsets) rows; the planner sees how small it is
    hits = (v.join(wins, "cohort")
             .filter((F.col(date) >= F.col("_lo")) & (F.col(date) <= F.col("_hi")))
             .groupBy("cohort", "offset").agg(F.count_distinct(entity).alias("retained")))
    out = wins.join(hits, ["cohort", "offset"], "left")
    return out.select("cohort", "offset", "cohort_size",
                      F.coalesce(F.col("retained"), F.lit(0)).cast("long").alias("retained"),
                      (F.coalesce(F.col("retained"), F.lit(0)) / F.col("cohort_size")).alias("retention"))


def seasonal_index(monthly: DataFrame, month_col: str, value: str) -> DataFrame:
    """Mean per calendar month / mean of the 12 monthly means; missing -> 1.0."""
    per = monthly.groupBy(F.month(month_col).alias("cal_month")).agg(F.avg(value).alias("_m"))
    grand = per.agg(F.avg("_m")).scalar()
    months = monthly.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("cal_month"))
    return (F.broadcast(months).join(per, "cal_month", "left")
            .select("cal_month", F.coalesce(F.col("_m") / grand, F.lit(1.0)).alias("seasonal_index")))


def ratio_of_sums(df: DataFrame, keys: Sequence[str], num: str, den: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(safe_divide(F.sum(num), F.sum(den)).alias(out))


def value_shares(df: DataFrame, segment: str, category: str, out: str = "share") -> DataFrame:
    """Frequency of each category within its segment, normalised."""
    c = df.groupBy(segment, category).agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(segment).agg(F.count(F.lit(1)).alias("_t"))
    return c.join(tot, segment).select(segment, category, "n", (F.col("n") / F.col("_t")).alias(out))


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bins over [lo, hi]; the top edge falls in the last bin."""
    b = F.least(F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return (df.filter(F.col(value).between(lo, hi))
              .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
