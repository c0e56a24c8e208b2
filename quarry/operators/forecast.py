"""Trend + level forecast per series (linear fit on the period index).

Per series: OLS slope/intercept over t = 0..n-1 (``regr_slope`` /
``regr_intercept``), population sd of the residuals, mean of the last three
values. Horizon h: 0.6 * (trend(n-1) + slope * h) + 0.4 * last3, floored at
half of last3, band +-1.64 sd with the lower edge floored at 0.
The input is one row per (series, period), already aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the forecast rule: trend weight, level weight, floor share,
# band width in residual sds.
TREND_W, LEVEL_W, FLOOR_SHARE, BAND_Z = 0.6, 0.4, 0.5, 1.64


def trend_forecast(series: DataFrame, key: str, t: str, y: str, horizons: int = 6,
                   keys_extra: Sequence[str] = ()) -> DataFrame:
    fit = series.groupBy(key).agg(F.regr_slope(y, t).alias("slope"), F.regr_intercept(y, t).alias("intercept"),
                                  F.max(t).alias("_tmax"), F.count(F.lit(1)).alias("n"))
    res = series.join(fit, key).withColumn("_r", F.col(y) - (F.col("slope") * F.col(t) + F.col("intercept")))
    sd = res.groupBy(key).agg(F.stddev_pop("_r").alias("sigma"),
                              F.avg(F.when(F.col(t) > F.col("_tmax") - 3, F.col(y))).alias("last3"))
    f = fit.join(sd, key)
    f = f.select(key, "slope", "sigma", "last3",
                 (F.col("slope") * F.col("_tmax") + F.col("intercept")).alias("last_trend"),
                 F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("h"))
    fc = F.greatest(F.lit(FLOOR_SHARE) * F.col("last3"),
                    F.lit(TREND_W) * (F.col("last_trend") + F.col("slope") * F.col("h")) + F.lit(LEVEL_W) * F.col("last3"))
    return f.select(key, "h", fc.alias("forecast"),
                    F.greatest(F.lit(0.0), fc - BAND_Z * F.col("sigma")).alias("lo"),
                    (fc + BAND_Z * F.col("sigma")).alias("hi"))
