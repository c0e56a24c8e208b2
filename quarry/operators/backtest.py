"""Backtests: bet summaries, daily strategy returns, Sharpe, compounding,
drawdown, monthly curves.

Per-bet rows are aggregated to one row per date before anything ordered
happens; running products / maxima over dates use the distributed prefix
scan, so no step needs a single-partition window.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordered import ordered_scan

# Flat stake per bet; trading periods per year for 5-day returns.
FLAT_BET = 100.0
PERIODS_PER_YEAR = 252 / 5


def bet_summary(bets: DataFrame, flag: str, pnl: str, won: str) -> DataFrame:
    """n bets, wins, win share, total P&L, ROI = P&L / (n * stake); zeros if none."""
    b = bets.filter(F.col(flag) == 1)
    s = b.agg(F.count(F.lit(1)).alias("n_bets"), F.sum(F.col(won).cast("long")).alias("wins"),
              F.sum(pnl).alias("total_pnl"))
    n = F.col("n_bets")
    return s.select("n_bets", F.coalesce("wins", F.lit(0)).alias("wins"),
                    F.when(n > 0, F.col("wins") / n).otherwise(0.0).alias("win_pct"),
                    F.when(n > 0, F.col("total_pnl") / (n * FLAT_BET)).otherwise(0.0).alias("roi"),
                    F.coalesce("total_pnl", F.lit(0.0)).alias("total_pnl"))


def monthly_pnl(bets: DataFrame, date: str, flag: str, pnl: str) -> DataFrame:
    """P&L and bet count per month over all rows (months without bets kept)."""
    m = F.date_format(date, "yyyy-MM")
    on = F.col(flag) == 1
    return bets.groupBy(m.alias("month")).agg(F.coalesce(F.sum(F.when(on, F.col(pnl))), F.lit(0.0)).alias("pnl"),
                                              F.count_if(on).alias("n"))


def running_pnl(bets: DataFrame, date: str, flag: str, pnl: str) -> DataFrame:
    """Cumulative P&L by date over bet rows (daily totals, then a scan)."""
    daily = bets.filter(F.col(flag) == 1).groupBy(date).agg(F.sum(pnl).alias("day_pnl"))
    return ordered_scan(daily, [date], {"cum_pnl": ("sum", "day_pnl")})


def daily_returns(trades: DataFrame, date: str, ret: str) -> DataFrame:
    return trades.groupBy(date).agg(F.avg(ret).alias("daily_ret"), F.count(F.lit(1)).alias("n"))


def sharpe(daily: DataFrame, ret: str = "daily_ret", periods: float = PERIODS_PER_YEAR) -> DataFrame:
    """mean * periods / (sample sd * sqrt(periods) + 1e-9)."""
    return daily.agg((F.avg(ret) * periods / (F.stddev_samp(ret) * math.sqrt(periods) + 1e-9)).alias("sharpe"))


def equity_curve(daily: DataFrame, date: str, ret: str = "daily_ret") -> DataFrame:
    """cum = prod(1 + r) over dates, running peak and drawdown cum/peak - 1."""
    d = daily.filter(F.col(ret).isNotNull()).withColumn("_g", 1 + F.col(ret))
    c = ordered_scan(d, [date], {"cum": ("prod", "_g")})
    c = ordered_scan(c, [date], {"peak": ("max", "cum")})
    return c.withColumn("drawdown", F.col("cum") / F.col("peak") - 1).drop("_g")


def month_end_last(series: DataFrame, date: str, value: str) -> DataFrame:
    """Last value per calendar month (max_by on date: a plain aggregate)."""
    return series.groupBy(F.date_format(date, "yyyy-MM").alias("month")).agg(
        F.max_by(value, date).alias(value), F.max(date).alias("last_date"))
