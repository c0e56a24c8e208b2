"""Statistics / evaluation / backtest queries (SURVEY sections D and I)
over given score columns: everything here is SQL-expressible and checked
against DuckDB. Model fits are in :mod:`quarry.plans.ml`."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.scalar import round_to, safe_divide
from quarry.operators import joins as J
from quarry.operators import aggregates as A
from quarry.operators import backtest as B
from quarry.operators import metrics as M
from quarry.operators import models as ML
from quarry.operators import tuning as TU
from quarry.operators import windows as W
from quarry.operators.forecast import trend_forecast
from quarry.operators.ordered import global_row_number
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.session import cut_lineage


def r6(c):
    return round_to(c, 6)


def r2(c):
    return round_to(c, 2)


# ------------------------------------------------ scored predictions table

def preds(spark, sf):
    """Per (ticker, date): 5-day momentum score as probability, forward
    5-day log return, target and prediction; rows with both known."""
    p, keys, order, own = W.keyed_frame(V.prices(spark, sf).select("ticker", "date", "close"), "ticker", "date", back=5, forward=5)
    r5 = W.log_return("close", keys, order, 5)
    fwd = F.ln(safe_divide(F.lead("close", 5).over(W._w(keys, order)), F.col("close")))
    prob = F.least(F.greatest(F.lit(0.5) + 4 * r5, F.lit(0.0)), F.lit(1.0))
    d = p.select("ticker", "date", fwd.alias("fwd"), prob.alias("prob"), own.alias("_own")).filter("_own").drop("_own")
    d = d.filter(F.col("fwd").isNotNull() & F.col("prob").isNotNull())
    return d.withColumn("pred", (F.col("prob") >= 0.5).cast("int")).withColumn("target", (F.col("fwd") > 0).cast("int"))


PREDS_SQL = """
preds AS (
  SELECT ticker, date, fwd, prob, CAST(prob >= 0.5 AS INTEGER) AS pred, CAST(fwd > 0 AS INTEGER) AS target FROM (
    SELECT ticker, date, ln(lead(close, 5) OVER w / close) AS fwd,
           least(greatest(0.5 + 4 * ln(close / lag(close, 5) OVER w), 0.0), 1.0) AS prob
    FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY date))
  WHERE fwd IS NOT NULL AND prob IS NOT NULL)"""


@query("confusion_metrics", views=["prices"], sql=f"""
, {PREDS_SQL},
c AS (SELECT COUNT(*) FILTER (WHERE pred = 1 AND target = 1) AS tp, COUNT(*) FILTER (WHERE pred = 1 AND target = 0) AS fp,
             COUNT(*) FILTER (WHERE pred = 0 AND target = 1) AS fn, COUNT(*) FILTER (WHERE pred = 0 AND target = 0) AS tn
      FROM preds)
SELECT tp, fp, fn, tn, round((tp + tn) * 1.0 / (tp + fp + fn + tn), 6) AS accuracy,
       round(COALESCE(tp * 1.0 / NULLIF(tp + fp, 0), 0), 6) AS precision,
       round(COALESCE(tp * 1.0 / NULLIF(tp + fn, 0), 0), 6) AS recall,
       round(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def confusion_metrics(spark, sf):
    c = M.confusion(preds(spark, sf), "prob", "target", 0.5)
    return c.select("tp", "fp", "fn", "tn", *[r6(F.col(x)).alias(x) for x in ["accuracy", "precision", "recall", "f1"]])


@query("auc_exact", views=["prices"], sql=f"""
, {PREDS_SQL},
r AS (SELECT target, rank() OVER (ORDER BY prob) AS rmin, COUNT(*) OVER (PARTITION BY prob) AS c FROM preds),
t AS (SELECT SUM(target) AS npos, COUNT(*) - SUM(target) AS nneg, COUNT(*) AS n FROM preds)
SELECT round(((SELECT SUM(rmin + (c - 1) / 2.0) FROM r WHERE target = 1) - npos * (npos + 1) / 2.0) / (npos * nneg), 6) AS auc,
       n FROM t""")
def auc_exact(spark, sf):
    a = M.auc_exact(preds(spark, sf), "prob", "target")
    return a.select(r6(F.col("auc")).alias("auc"), "n")


@query("logloss_brier", views=["prices"], sql=f"""
, {PREDS_SQL}
SELECT round(avg(-(target * ln(least(greatest(prob, 1e-15), 1 - 1e-15))
                  + (1 - target) * ln(1 - least(greatest(prob, 1e-15), 1 - 1e-15)))), 6) AS log_loss,
       round(avg((prob - target) * (prob - target)), 6) AS brier, COUNT(*) AS n FROM preds""")
def logloss_brier(spark, sf):
    m = M.logloss_brier(preds(spark, sf), "prob", "target")
    return m.select(r6(F.col("log_loss")).alias("log_loss"), r6(F.col("brier")).alias("brier"), "n")


@query("roc_pr_points", views=["prices"], sql=f"""
, {PREDS_SQL},
c AS (SELECT prob AS threshold, CAST(SUM(target) AS BIGINT) AS pos, CAST(SUM(1 - target) AS BIGINT) AS neg
      FROM preds GROUP BY prob),
s AS (SELECT threshold, CAST(SUM(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
             CAST(SUM(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
             row_number() OVER (ORDER BY threshold DESC) AS i, COUNT(*) OVER () AS k FROM c),
t AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM c)
SELECT round(threshold, 6) AS threshold, tp, fp, round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr,
       round(tp * 1.0 / (tp + fp), 6) AS precision
FROM s, t WHERE (i - 1) % greatest(CAST(ceil(k / 50.0) AS BIGINT), 1) = 0 OR i = k""")
def roc_pr_points(spark, sf):
    r = M.roc_pr_points(preds(spark, sf), "prob", "target", 50)
    return r.select(r6(F.col("threshold")).alias("threshold"), "tp", "fp",
                    *[r6(F.col(c)).alias(c) for c in ["tpr", "fpr", "precision"]])


THRESHOLDS = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]


@query("threshold_sweep", views=["prices"], sql=f"""
, {PREDS_SQL},
th AS (SELECT CAST(unnest([{", ".join(repr(t) for t in THRESHOLDS)}]) AS DOUBLE) AS threshold),
c AS (SELECT threshold, COUNT(*) FILTER (WHERE prob >= threshold AND target = 1) AS tp,
             COUNT(*) FILTER (WHERE prob >= threshold AND target = 0) AS fp,
             COUNT(*) FILTER (WHERE prob < threshold AND target = 1) AS fn FROM preds, th GROUP BY threshold)
SELECT threshold, tp, fp, fn, round(COALESCE(tp * 1.0 / NULLIF(tp + fp, 0), 0), 6) AS precision,
       round(COALESCE(tp * 1.0 / NULLIF(tp + fn, 0), 0), 6) AS recall,
       round(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def threshold_sweep(spark, sf):
    s = M.threshold_sweep(preds(spark, sf), "prob", "target", THRESHOLDS)
    return s.select("threshold", "tp", "fp", "fn", *[r6(F.col(c)).alias(c) for c in ["precision", "recall", "f1"]])


@query("fold_auc_table", views=["prices"], sql=f"""
, {PREDS_SQL},
r AS (SELECT year(date) AS fold, target, rank() OVER (PARTITION BY year(date) ORDER BY prob) AS rmin,
             COUNT(*) OVER (PARTITION BY year(date), prob) AS c FROM preds),
t AS (SELECT year(date) AS fold, SUM(target) AS npos, COUNT(*) - SUM(target) AS nneg, COUNT(*) AS n FROM preds GROUP BY 1),
s AS (SELECT fold, SUM(rmin + (c - 1) / 2.0) AS rs FROM r WHERE target = 1 GROUP BY fold)
SELECT CAST(t.fold AS INTEGER) AS fold, round((s.rs - npos * (npos + 1) / 2.0) / (npos * nneg), 6) AS auc, n
FROM t JOIN s ON t.fold = s.fold""")
def fold_auc_table(spark, sf):
    p = preds(spark, sf).withColumn("fold", F.year("date"))
    a = M.auc_exact(p, "prob", "target", groups=["fold"])
    return a.select("fold", r6(F.col("auc")).alias("auc"), "n")


_STRAT_SQL = """
trades AS (SELECT date, CASE WHEN pred = 1 THEN fwd ELSE -fwd END AS ret FROM preds WHERE prob >= 0.6),
daily AS (SELECT date, avg(ret) AS r FROM trades GROUP BY date),
curve AS (SELECT date, r, product(1 + r) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
          FROM daily),
dd AS (SELECT *, cum / max(cum) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS drawdown
       FROM curve)"""


def _strategy(spark, sf):
    p = preds(spark, sf).filter(F.col("prob") >= 0.6)
    t = p.withColumn("ret", F.when(F.col("pred") == 1, F.col("fwd")).otherwise(-F.col("fwd")))
    return t


@query("backtest_stats", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
SELECT (SELECT COUNT(*) FROM trades) AS total_trades,
       (SELECT round(avg(CAST(ret > 0 AS INTEGER)), 6) FROM trades) AS win_rate,
       (SELECT round(avg(r) * 50.4 / (stddev_samp(r) * sqrt(50.4) + 1e-9), 6) FROM daily) AS sharpe,
       (SELECT round(MIN(drawdown), 6) FROM dd) AS max_drawdown,
       (SELECT round(arg_max(cum, date) - 1, 6) FROM dd) AS total_return""")
def backtest_stats(spark, sf):
    t = _strategy(spark, sf)
    daily = B.daily_returns(t, "date", "ret")
    curve = B.equity_curve(daily, "date")
    trades = t.agg(F.count(F.lit(1)).alias("total_trades"), r6(F.avg((F.col("ret") > 0).cast("int"))).alias("win_rate"))
    sh = B.sharpe(daily).select("sharpe").scalar()
    dd = curve.agg(F.min("drawdown")).scalar()
    tot = curve.agg(F.max_by("cum", "date")).scalar()
    return trades.select("total_trades", "win_rate", r6(sh).alias("sharpe"), r6(dd).alias("max_drawdown"),
                         r6(tot - 1).alias("total_return"))


@query("daily_mean_return", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
SELECT date, round(r, 6) + 0.0 AS daily_ret FROM daily""")
def daily_mean_return(spark, sf):
    d = B.daily_returns(_strategy(spark, sf), "date", "ret")
    return d.select("date", r6(F.col("daily_ret")).alias("daily_ret"))


@query("sharpe_ratio", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
SELECT round(avg(r) * 50.4 / (stddev_samp(r) * sqrt(50.4) + 1e-9), 6) AS sharpe FROM daily""")
def sharpe_ratio(spark, sf):
    d = B.daily_returns(_strategy(spark, sf), "date", "ret")
    return B.sharpe(d).select(r6(F.col("sharpe")).alias("sharpe"))


@query("cum_product", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
SELECT date, round(cum, 6) + 0.0 AS cum FROM curve""")
def cum_product(spark, sf):
    c = B.equity_curve(B.daily_returns(_strategy(spark, sf), "date", "ret"), "date")
    return c.select("date", r6(F.col("cum")).alias("cum"))


@query("running_max_drawdown", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
SELECT date, round(drawdown, 6) + 0.0 AS drawdown FROM dd""")
def running_max_drawdown(spark, sf):
    c = B.equity_curve(B.daily_returns(_strategy(spark, sf), "date", "ret"), "date")
    return c.select("date", r6(F.col("drawdown")).alias("drawdown"))


@query("month_end_last", views=["prices"], sql=f"""
, {PREDS_SQL}, {_STRAT_SQL}
, me AS (SELECT strftime(date, '%Y-%m') AS month, arg_max(cum, date) AS cum FROM curve GROUP BY 1)
SELECT month, round(cum * 100, 4) + 0.0 AS value, round((cum / NULLIF(lag(cum) OVER (ORDER BY month), 0) - 1) * 100, 4) + 0.0 AS month_return,
       round(cum / NULLIF(first_value(cum) OVER (ORDER BY month), 0) * 100, 4) + 0.0 AS indexed FROM me""")
def month_end_last(spark, sf):
    c = B.equity_curve(B.daily_returns(_strategy(spark, sf), "date", "ret"), "date")
    m = B.month_end_last(c, "date", "cum")
    months = Window.orderBy("month")  # one row a month: the calendar bounds it
    return m.select("month", round_to(F.col("cum") * 100, 4).alias("value"),
                    round_to((safe_divide(F.col("cum"), F.lag("cum").over(months)) - 1) * 100, 4).alias("month_return"),
                    round_to(safe_divide(F.col("cum"), F.first("cum").over(months)) * 100, 4).alias("indexed"))


# ------------------------------------------------------------ bets

from quarry.plans.scalars import _BET_SQL, _bets  # noqa: E402


@query("bet_summary", views=["games"], sql=f"""
, {_BET_SQL}
SELECT COUNT(*) AS n_bets, COALESCE(CAST(SUM(side_won) AS BIGINT), 0) AS wins,
       round(CASE WHEN COUNT(*) > 0 THEN SUM(side_won) * 1.0 / COUNT(*) ELSE 0 END, 6) AS win_pct,
       round(CASE WHEN COUNT(*) > 0 THEN SUM(pnl) / (COUNT(*) * 100.0) ELSE 0 END, 6) AS roi,
       round(COALESCE(SUM(pnl), 0), 2) AS total_pnl
FROM placed WHERE bet_a = 1""")
def bet_summary(spark, sf):
    s = B.bet_summary(_bets(spark, sf), "bet_a", "pnl", "side_won")
    return s.select("n_bets", "wins", r6(F.col("win_pct")).alias("win_pct"), r6(F.col("roi")).alias("roi"),
                    r2(F.col("total_pnl")).alias("total_pnl"))


@query("monthly_pnl", views=["games"], sql=f"""
, {_BET_SQL}
SELECT strftime(game_date, '%Y-%m') AS month, round(COALESCE(SUM(pnl) FILTER (WHERE bet_a = 1), 0), 2) AS pnl,
       COUNT(*) FILTER (WHERE bet_a = 1) AS n FROM placed GROUP BY 1""")
def monthly_pnl(spark, sf):
    m = B.monthly_pnl(_bets(spark, sf), "game_date", "bet_a", "pnl")
    return m.select("month", r2(F.col("pnl")).alias("pnl"), "n")


@query("running_sum_pnl", views=["games"], sql=f"""
, {_BET_SQL},
d AS (SELECT game_date, SUM(pnl) AS day_pnl FROM placed WHERE bet_a = 1 GROUP BY game_date)
SELECT game_date, round(SUM(day_pnl) OVER (ORDER BY game_date), 2) AS cum_pnl FROM d""")
def running_sum_pnl(spark, sf):
    r = B.running_pnl(_bets(spark, sf), "game_date", "bet_a", "pnl")
    return r.select("game_date", r2(F.col("cum_pnl")).alias("cum_pnl"))


# ------------------------------------------------------------ sectors

@query("sector_returns", views=["prices", "tickers"], sql="""
WITH r AS (SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM prices)
SELECT t.sector, strftime(r.date, '%Y-%m') AS month, round(avg(r.ret), 6) AS avg_daily_ret, COUNT(r.ret) AS n
FROM r JOIN tickers t ON r.ticker = t.ticker GROUP BY 1, 2""")
def sector_returns(spark, sf):
    p = V.prices(spark, sf).withColumn("ret", W.pct_change("close", "ticker", "date"))
    j = p.join(V.tickers(spark, sf).select("ticker", "sector"), "ticker")
    return j.groupBy("sector", F.date_format("date", "yyyy-MM").alias("month")).agg(
        r6(F.avg("ret")).alias("avg_daily_ret"), F.count("ret").alias("n"))


# ------------------------------------------------------------ scaling / labels

_RFM_SQL = """
rfm AS (SELECT patient_id, CAST(date_diff('day', MAX(appt_date), (SELECT MAX(appt_date) + 1 FROM appointments WHERE no_show = 0)) AS DOUBLE) AS recency,
               CAST(COUNT(*) AS DOUBLE) AS frequency, SUM(revenue) AS monetary
        FROM appointments WHERE no_show = 0 GROUP BY patient_id)"""


def _rfm(spark, sf):
    att = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    snap = F.date_add(att.agg(F.max("appt_date")).scalar(), 1)
    r = A.rfm(att, "patient_id", "appt_date", "revenue", snap)
    return r.select("patient_id", F.col("recency").cast("double").alias("recency"),
                    F.col("frequency").cast("double").alias("frequency"), "monetary")


@query("standard_scale", views=["appointments"], sql=f"""
, {_RFM_SQL}
SELECT patient_id, round((recency - avg(recency) OVER ()) / stddev_pop(recency) OVER (), 6) AS z_recency,
       round((frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER (), 6) AS z_frequency,
       round((monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER (), 6) AS z_monetary FROM rfm""")
def standard_scale(spark, sf):
    r = _rfm(spark, sf)
    cols = ["recency", "frequency", "monetary"]
    # population sd (not Spark ML's sample-sd scaler); stats are one scalar row
    stats = r.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    row = {c: (stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()) for c in cols}
    return r.select("patient_id", *[r6((F.col(c) - row[c][0]) / row[c][1]).alias(f"z_{c}") for c in cols])


# Fixed value: days without a visit after which a patient counts as churned.
CHURN_DAYS = 548


@query("churn_label", views=["appointments", "patients"], sql=f"""
, {_RFM_SQL}
SELECT p.patient_id, CAST(COALESCE(rfm.recency > {CHURN_DAYS}, true) AS INTEGER) AS churned,
       CAST(rfm.patient_id IS NULL AS INTEGER) AS never_visited
FROM patients p LEFT JOIN rfm ON p.patient_id = rfm.patient_id""")
def churn_label(spark, sf):
    r = _rfm(spark, sf)
    p = V.patients(spark, sf).select("patient_id").join(r, "patient_id", "left")
    return p.select("patient_id", F.coalesce(F.col("recency") > CHURN_DAYS, F.lit(True)).cast("int").alias("churned"),
                    F.col("recency").isNull().cast("int").alias("never_visited"))


@query("stratified_split", views=["appointments"], sql="""
WITH h AS (SELECT appt_id, no_show, ((appt_id % 1000003) * 2654435761) % 4294967296 AS hh FROM appointments),
r AS (SELECT appt_id, row_number() OVER (PARTITION BY no_show ORDER BY hh, appt_id) AS rk,
             COUNT(*) OVER (PARTITION BY no_show) AS n FROM h)
SELECT appt_id, CASE WHEN rk <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""")
def stratified_split(spark, sf):
    a = V.appointments(spark, sf).select("appt_id", "no_show")
    return M.stratified_split(a, "appt_id", "no_show", 0.8).select("appt_id", "split")


@query("linear_trend_forecast", views=["appointments"], sql="""
WITH m AS (SELECT strftime(appt_date, '%Y-%m') AS month,
                  COALESCE(SUM(revenue) FILTER (WHERE is_cosmetic = 0), 0) AS medical,
                  COALESCE(SUM(revenue) FILTER (WHERE is_cosmetic = 1), 0) AS cosmetic
           FROM appointments WHERE no_show = 0 GROUP BY 1),
l AS (SELECT 'medical' AS series, month, medical AS y FROM m UNION ALL SELECT 'cosmetic', month, cosmetic FROM m),
i AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY month) - 1 AS t FROM l),
f AS (SELECT series, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, MAX(t) AS tmax FROM i GROUP BY series),
s AS (SELECT i.series, stddev_pop(i.y - (f.slope * i.t + f.intercept)) AS sigma,
             avg(CASE WHEN i.t > f.tmax - 3 THEN i.y END) AS last3 FROM i JOIN f ON i.series = f.series GROUP BY i.series),
fc AS (SELECT f.series, h, greatest(0.5 * s.last3, 0.6 * (f.slope * f.tmax + f.intercept + f.slope * h) + 0.4 * s.last3) AS v,
              s.sigma FROM f JOIN s ON f.series = s.series, (SELECT unnest(range(1, 7)) AS h))
SELECT series, CAST(h AS INTEGER) AS h, round(v, 2) AS forecast, round(greatest(0, v - 1.64 * sigma), 2) AS lo,
       round(v + 1.64 * sigma, 2) AS hi FROM fc""")
def linear_trend_forecast(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    m = A.pivot_sum(a.withColumn("month", F.date_format("appt_date", "yyyy-MM")), "month", "is_cosmetic", "revenue",
                    [0, 1], names=["medical", "cosmetic"])
    idx = global_row_number(m.select("month"), ["month"], "_t").select("month", (F.col("_t") - 1).alias("t"))
    long = m.join(idx, "month").select("t", F.stack(F.lit(2), F.lit("medical"), "medical", F.lit("cosmetic"), "cosmetic")
                                       .alias("series", "y"))
    f = trend_forecast(long, "series", "t", "y", 6)
    return f.select("series", "h", r2(F.col("forecast")).alias("forecast"), r2(F.col("lo")).alias("lo"),
                    r2(F.col("hi")).alias("hi"))


# ------------------------------------------------------------ teams / screener

@query("team_ratings", views=["games"], sql="""
WITH h AS (SELECT * FROM games WHERE is_home = 1),
l AS (SELECT team_abbr, arg_max(game_date, game_date) AS game_date, arg_max(pts, game_date) AS pts,
             arg_max(opp_pts, game_date) AS opp_pts, arg_max(fga, game_date) AS fga, arg_max(fta, game_date) AS fta,
             arg_max(oreb, game_date) AS oreb, arg_max(tov, game_date) AS tov FROM h GROUP BY team_abbr),
w AS (SELECT team_abbr, SUM(win) * 1.0 / COUNT(*) AS win_pct FROM games GROUP BY team_abbr)
SELECT l.team_abbr, l.game_date, l.pts, l.opp_pts, round(l.pts - l.opp_pts, 1) AS margin, l.fga, l.fta,
       round(l.fga - l.oreb + l.tov + 0.4 * l.fta, 1) AS poss, round(w.win_pct, 4) AS win_pct
FROM l JOIN w ON l.team_abbr = w.team_abbr""")
def team_ratings(spark, sf):
    g = V.games(spark, sf)
    last = W.last_row_per_key(g.filter(F.col("is_home") == 1).select("team_abbr", "game_date", "pts", "opp_pts", "fga",
                                                                       "fta", "oreb", "tov"), ["team_abbr"], ["game_date"])
    w = g.groupBy("team_abbr").agg((F.sum("win") / F.count(F.lit(1))).alias("_wp"))
    j = last.join(w, "team_abbr")
    return j.select("team_abbr", "game_date", "pts", "opp_pts", round_to(F.col("pts") - F.col("opp_pts"), 1).alias("margin"),
                    "fga", "fta", round_to(F.col("fga") - F.col("oreb") + F.col("tov") + 0.4 * F.col("fta"), 1).alias("poss"),
                    round_to("_wp", 4).alias("win_pct"))


@query("screener_output", views=["prices", "tickers"], sql=f"""
, {PREDS_SQL},
l AS (SELECT ticker, arg_max(prob, date) AS prob FROM preds GROUP BY ticker)
SELECT l.ticker, t.sector, round(l.prob, 6) AS prob, row_number() OVER (ORDER BY l.prob DESC, l.ticker) AS rank,
       CASE WHEN l.prob >= 0.65 THEN 'strong buy' WHEN l.prob >= 0.60 THEN 'buy'
            WHEN l.prob <= 0.35 THEN 'strong sell' ELSE 'hold' END AS tier
FROM l JOIN tickers t ON l.ticker = t.ticker""")
def screener_output(spark, sf):
    p = preds(spark, sf).select("ticker", "date", "prob")
    last = W.last_row_per_key(p, ["ticker"], ["date"]).join(V.tickers(spark, sf).select("ticker", "sector"),
                                                            "ticker")
    ranked = global_row_number(last, [("prob", False), "ticker"], "rank")
    tier = (F.when(F.col("prob") >= 0.65, "strong buy").when(F.col("prob") >= 0.60, "buy")
             .when(F.col("prob") <= 0.35, "strong sell").otherwise("hold"))
    return ranked.select("ticker", "sector", r6(F.col("prob")).alias("prob"), "rank", tier.alias("tier"))


@query("matchup_feature_vector", views=["games"], sql="""
WITH h AS (SELECT team_abbr, arg_max(pts, game_date) AS pts, arg_max(fga, game_date) AS fga FROM games
           WHERE is_home = 1 GROUP BY team_abbr),
a AS (SELECT team_abbr, arg_max(pts, game_date) AS pts, arg_max(fga, game_date) AS fga FROM games
      WHERE is_home = 0 GROUP BY team_abbr)
SELECT h.team_abbr AS home, a.team_abbr AS away, h.pts AS home_pts, a.pts AS away_pts, h.pts - a.pts AS diff_pts,
       h.fga - a.fga AS diff_fga, CAST(0.0 AS DOUBLE) AS elo_diff
FROM h JOIN a ON h.team_abbr <> a.team_abbr""")
def matchup_feature_vector(spark, sf):
    g = V.games(spark, sf)
    h = W.last_row_per_key(g.filter(F.col("is_home") == 1).select("team_abbr", "game_date", "pts", "fga"),
                           ["team_abbr"], ["game_date"])
    a = W.last_row_per_key(g.filter(F.col("is_home") == 0).select("team_abbr", "game_date", "pts", "fga"),
                           ["team_abbr"], ["game_date"])
    hh = h.select(F.col("team_abbr").alias("home"), F.col("pts").alias("home_pts"), F.col("fga").alias("_hf"))
    aa = a.select(F.col("team_abbr").alias("away"), F.col("pts").alias("away_pts"), F.col("fga").alias("_af"))
    # the requested matchups: here every ordered pair of the team list
    asked = J.ordered_pairs(h.select("team_abbr").unionByName(a.select("team_abbr")).distinct(), "team_abbr")
    j = asked.join(hh, "home").join(aa, "away")
    return j.select("home", "away", "home_pts", "away_pts", (F.col("home_pts") - F.col("away_pts")).alias("diff_pts"),
                    (F.col("_hf") - F.col("_af")).alias("diff_fga"),
                    F.lit(0.0).alias("elo_diff"))   # reference value at inference (see SURVEY V11)


# ------------------------------------------------------------ subscribers (churn page)

@query("rate_by_band", views=["subscribers"], sql="""
SELECT 'contract' AS dimension, contract AS band, round(avg(churn), 6) AS churn_rate, COUNT(*) AS n
FROM subscribers GROUP BY contract
UNION ALL
SELECT 'tenure', CASE WHEN tenure <= 12 THEN '0-12' WHEN tenure <= 24 THEN '13-24' WHEN tenure <= 48 THEN '25-48'
                      ELSE '49+' END, round(avg(churn), 6), COUNT(*) FROM subscribers GROUP BY 2""")
def rate_by_band(spark, sf):
    s = V.subscribers(spark, sf)
    band = (F.when(F.col("tenure") <= 12, "0-12").when(F.col("tenure") <= 24, "13-24")
             .when(F.col("tenure") <= 48, "25-48").otherwise("49+"))
    a = s.groupBy(F.lit("contract").alias("dimension"), F.col("contract").alias("band")).agg(
        r6(F.avg("churn")).alias("churn_rate"), F.count(F.lit(1)).alias("n"))
    b = s.groupBy(F.lit("tenure").alias("dimension"), band.alias("band")).agg(
        r6(F.avg("churn")).alias("churn_rate"), F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@query("mean_by_label", views=["subscribers"], sql="""
SELECT churn, round(avg(monthly_charges), 6) AS avg_monthly, COUNT(*) AS n,
       round(COUNT(*) * 1.0 / SUM(COUNT(*)) OVER (), 6) AS share FROM subscribers GROUP BY churn""")
def mean_by_label(spark, sf):
    s = V.subscribers(spark, sf)
    g = s.groupBy("churn").agg(F.avg("monthly_charges").alias("_m"), F.count(F.lit(1)).alias("n"))
    total = s.agg(F.count(F.lit(1))).scalar()
    return g.select("churn", r6(F.col("_m")).alias("avg_monthly"), "n", r6(F.col("n") / total).alias("share"))


_SUB_PROB = "1.0 / (1.0 + exp((tenure - 24) / 12.0))"


@query("value_at_risk_top_n", views=["subscribers"], sql=f"""
WITH t AS (SELECT customer_id, monthly_charges FROM subscribers ORDER BY {_SUB_PROB} DESC, customer_id LIMIT 100)
SELECT round(SUM(12 * monthly_charges), 2) AS value_at_risk, COUNT(*) AS n FROM t""")
def value_at_risk_top_n(spark, sf):
    s = V.subscribers(spark, sf).withColumn("prob", 1.0 / (1.0 + F.exp((F.col("tenure") - 24) / 12.0)))
    top = s.orderBy(F.desc("prob"), "customer_id").limit(100)
    return top.agg(r2(F.sum(12 * F.col("monthly_charges"))).alias("value_at_risk"), F.count(F.lit(1)).alias("n"))


@query("segment_ratio", views=["subscribers"], sql="""
SELECT round(avg(churn) FILTER (WHERE contract = 'AUTOMOBILE') / NULLIF(avg(churn) FILTER (WHERE contract = 'BUILDING'), 0), 6) AS contract_ratio,
       round(avg(churn) FILTER (WHERE contract = 'AUTOMOBILE' AND tenure < 12) / NULLIF(avg(churn), 0), 6) AS joint_vs_all
FROM subscribers""")
def segment_ratio(spark, sf):
    s = V.subscribers(spark, sf)
    a = F.avg(F.when(F.col("contract") == "AUTOMOBILE", F.col("churn")))
    b = F.avg(F.when(F.col("contract") == "BUILDING", F.col("churn")))
    j = F.avg(F.when((F.col("contract") == "AUTOMOBILE") & (F.col("tenure") < 12), F.col("churn")))
    return s.agg(r6(safe_divide(a, b)).alias("contract_ratio"), r6(safe_divide(j, F.avg("churn"))).alias("joint_vs_all"))


# ------------------------------------------------------------ e-commerce page

@query("monthly_revenue", views=["shop_orders"], sql="""
WITH m AS (SELECT strftime(order_date, '%Y-%m') AS month, SUM(revenue) AS rev FROM shop_orders GROUP BY 1)
SELECT a.month, round(a.rev, 2) AS revenue, round((a.rev / b.rev - 1) * 100, 4) AS mom_growth_pct
FROM m a LEFT JOIN m b ON b.month = strftime(CAST(strptime(a.month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH AS DATE), '%Y-%m')""")
def monthly_revenue(spark, sf):
    o = V.shop_orders(spark, sf)
    m = o.groupBy(F.date_format("order_date", "yyyy-MM").alias("month")).agg(F.sum("revenue").alias("rev"))
    # previous month by a join on the shifted key (the month table is calendar-bounded)
    prev = m.select(F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM").alias("month"),
                    F.col("rev").alias("_prev"))
    j = m.join(prev, "month", "left")
    return j.select("month", r2(F.col("rev")).alias("revenue"),
                    round_to((F.col("rev") / F.col("_prev") - 1) * 100, 4).alias("mom_growth_pct"))


@query("category_topk_share", views=["payer"], sql="""
WITH c AS (SELECT description AS category, SUM(allowed) AS rev FROM payer GROUP BY 1)
SELECT category, round(rev, 2) AS revenue, round(rev * 100.0 / (SELECT SUM(rev) FROM c), 4) AS share_pct,
       round(rev / (SELECT MAX(rev) FROM c), 6) AS width FROM c ORDER BY rev DESC, category LIMIT 10""")
def category_topk_share(spark, sf):
    c = V.payer(spark, sf).groupBy(F.col("description").alias("category")).agg(F.sum("allowed").alias("rev"))
    tot, mx = c.agg(F.sum("rev")).scalar(), c.agg(F.max("rev")).scalar()
    top = c.orderBy(F.desc("rev"), "category").limit(10)
    return top.select("category", r2(F.col("rev")).alias("revenue"), round_to(F.col("rev") * 100.0 / tot, 4).alias("share_pct"),
                      r6(F.col("rev") / mx).alias("width"))


@query("region_orders_delay", views=["shop_orders"], sql="""
SELECT state, round(SUM(revenue), 2) AS revenue, COUNT(DISTINCT order_id) AS n_orders,
       round(avg(delivery_days), 6) AS avg_delivery_days FROM shop_orders GROUP BY state
ORDER BY SUM(revenue) DESC, state LIMIT 10""")
def region_orders_delay(spark, sf):
    o = V.shop_orders(spark, sf)
    g = o.groupBy("state").agg(F.sum("revenue").alias("_r"), F.count_distinct("order_id").alias("n_orders"),
                               F.avg("delivery_days").alias("_d"))
    return g.orderBy(F.desc("_r"), "state").limit(10).select("state", r2(F.col("_r")).alias("revenue"), "n_orders",
                                                             r6(F.col("_d")).alias("avg_delivery_days"))


@query("repeat_rate", views=["shop_orders"], sql="""
WITH c AS (SELECT state, customer_id, COUNT(*) AS n FROM shop_orders GROUP BY 1, 2)
SELECT state, round(avg(CAST(n >= 2 AS INTEGER)), 6) AS repeat_rate, COUNT(*) AS n_customers FROM c GROUP BY state""")
def repeat_rate(spark, sf):
    c = V.shop_orders(spark, sf).groupBy("state", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("state").agg(r6(F.avg((F.col("n") >= 2).cast("int"))).alias("repeat_rate"),
                                  F.count(F.lit(1)).alias("n_customers"))


@query("delay_band_score", views=["shop_orders"], sql="""
SELECT CASE WHEN delivery_days <= 7 THEN '<=7' WHEN delivery_days <= 14 THEN '8-14' WHEN delivery_days <= 21 THEN '15-21'
            ELSE '>21' END AS band, round(avg(score), 6) AS avg_score, COUNT(*) AS n_orders FROM shop_orders GROUP BY 1""")
def delay_band_score(spark, sf):
    o = V.shop_orders(spark, sf)
    d = F.col("delivery_days")
    band = F.when(d <= 7, "<=7").when(d <= 14, "8-14").when(d <= 21, "15-21").otherwise(">21")
    return o.groupBy(band.alias("band")).agg(r6(F.avg("score")).alias("avg_score"), F.count(F.lit(1)).alias("n_orders"))


@query("payment_mix", views=["shop_orders"], sql="""
WITH p AS (SELECT payment_type, SUM(revenue) AS rev, COUNT(*) AS n FROM shop_orders GROUP BY 1)
SELECT payment_type, round(rev, 2) AS revenue, n AS n_orders, round(rev * 100.0 / (SELECT SUM(rev) FROM p), 4) AS share_pct
FROM p""")
def payment_mix(spark, sf):
    p = V.shop_orders(spark, sf).groupBy("payment_type").agg(F.sum("revenue").alias("rev"),
                                                             F.count(F.lit(1)).alias("n_orders"))
    s = A.share_of_total(p, "rev", "share_pct", 100.0)
    return s.select("payment_type", r2(F.col("rev")).alias("revenue"), "n_orders",
                    round_to("share_pct", 4).alias("share_pct"))


@query("correlation", views=["shop_orders"], sql="""
SELECT round(corr(delivery_days, score), 6) AS r FROM shop_orders""")
def correlation(spark, sf):
    return V.shop_orders(spark, sf).agg(r6(F.corr("delivery_days", "score")).alias("r"))


@query("headline_kpis", views=["shop_orders", "payer"], sql="""
SELECT round(SUM(revenue), 2) AS total_revenue, round(avg(revenue), 2) AS avg_order_value,
       round(avg(delivery_days), 4) AS avg_delivery_days, COUNT(*) AS n_orders,
       (SELECT round(MAX(r) * 100.0 / SUM(r), 4) FROM (SELECT SUM(allowed) AS r FROM payer GROUP BY description)) AS top_category_share
FROM shop_orders""")
def headline_kpis(spark, sf):
    o = V.shop_orders(spark, sf)
    c = V.payer(spark, sf).groupBy("description").agg(F.sum("allowed").alias("r"))
    top = c.agg(round_to(F.max("r") * 100.0 / F.sum("r"), 4)).scalar()
    return o.agg(r2(F.sum("revenue")).alias("total_revenue"), r2(F.avg("revenue")).alias("avg_order_value"),
                 round_to(F.avg("delivery_days"), 4).alias("avg_delivery_days"), F.count(F.lit(1)).alias("n_orders"),
                 top.alias("top_category_share"))


@query("cleaned_summary", views=["prices"], sql=f"""
, {PREDS_SQL}
SELECT round(avg(target), 6) AS positive_share, MIN(date) AS min_date, MAX(date) AS max_date,
       COUNT(DISTINCT ticker) AS n_tickers, COUNT(*) AS n_rows FROM preds""")
def cleaned_summary(spark, sf):
    p = preds(spark, sf)
    return p.agg(r6(F.avg("target")).alias("positive_share"), F.min("date").alias("min_date"),
                 F.max("date").alias("max_date"), F.count_distinct("ticker").alias("n_tickers"),
                 F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------ folds

# Fixed values of the walk-forward scheme (days): train span, embargo, test
# span, step; minimum rows per train / test fold.
WF_TRAIN_DAYS, WF_EMBARGO, WF_TEST_DAYS, WF_STEP = 3 * 365, 10, 90, 90
WF_MIN_TRAIN, WF_MIN_TEST = 5000, 500


@query("walk_forward_folds", views=["prices"], sql=f"""
, {PREDS_SQL},
b AS (SELECT MIN(date) AS d0, MAX(date) AS d1 FROM preds),
c AS (SELECT date, COUNT(*) AS n FROM preds GROUP BY date),
f AS (SELECT k, CAST(d0 + INTERVAL ({WF_TRAIN_DAYS} + {WF_EMBARGO}) DAY + k * INTERVAL {WF_STEP} DAY AS DATE) AS test_start
      FROM b, (SELECT unnest(range(0, greatest(date_diff('day', d0, d1) - ({WF_TRAIN_DAYS} + {WF_EMBARGO}), 0) // {WF_STEP} + 1)) AS k
               FROM b) ks),
f2 AS (SELECT k, test_start, CAST(test_start + INTERVAL {WF_TEST_DAYS} DAY AS DATE) AS test_end,
              CAST(test_start - INTERVAL {WF_EMBARGO} DAY AS DATE) AS train_end,
              CAST(test_start - INTERVAL ({WF_EMBARGO} + {WF_TRAIN_DAYS}) DAY AS DATE) AS train_start
       FROM f, b WHERE test_start <= d1),
cnt AS (SELECT f2.k, f2.train_start, f2.train_end, f2.test_start, f2.test_end,
               COALESCE(SUM(c.n) FILTER (WHERE c.date >= f2.train_start AND c.date < f2.train_end), 0) AS n_train,
               COALESCE(SUM(c.n) FILTER (WHERE c.date >= f2.test_start AND c.date < f2.test_end), 0) AS n_test
        FROM f2 LEFT JOIN c ON c.date >= f2.train_start AND c.date < f2.test_end GROUP BY 1, 2, 3, 4, 5),
kept AS (SELECT * FROM cnt WHERE n_train >= {WF_MIN_TRAIN} AND n_test >= {WF_MIN_TEST})
SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS fold, train_start, train_end, test_start, test_end,
       CAST(n_train AS BIGINT) AS n_train, CAST(n_test AS BIGINT) AS n_test FROM kept""")
def walk_forward_folds(spark, sf):
    p = preds(spark, sf)
    d0, d1 = p.agg(F.min("date")).scalar(), p.agg(F.max("date")).scalar()
    # the fold table is generated from a sequence over the data's date span:
    # (span / step) rows, tiny, no fixed cap
    n_folds = F.floor(F.greatest(F.datediff(d1, d0) - (WF_TRAIN_DAYS + WF_EMBARGO), F.lit(0)) / WF_STEP)
    ks = p.agg(F.count(F.lit(1))).select(F.explode(F.sequence(F.lit(0), n_folds.cast("int"))).alias("k"))
    f = ks.select("k", F.date_add(d0, F.lit(WF_TRAIN_DAYS + WF_EMBARGO) + F.col("k") * WF_STEP).alias("test_start"))
    f = f.filter(F.col("test_start") <= d1)
    f = f.select("k", "test_start", F.date_add("test_start", WF_TEST_DAYS).alias("test_end"),
                 F.date_sub("test_start", WF_EMBARGO).alias("train_end"),
                 F.date_sub("test_start", WF_EMBARGO + WF_TRAIN_DAYS).alias("train_start"))
    daily = p.groupBy("date").agg(F.count(F.lit(1)).alias("n"))   # one row per date
    # each fold's days, so that the join is an equality (folds x days of a fold)
    days = f.withColumn("date", F.explode(F.sequence("train_start", F.date_sub("test_end", 1))))
    j = daily.join(days, "date")
    cnt = j.groupBy("k").agg(
        F.sum(F.when((F.col("date") >= F.col("train_start")) & (F.col("date") < F.col("train_end")), F.col("n"))
              .otherwise(0)).alias("n_train"),
        F.sum(F.when((F.col("date") >= F.col("test_start")) & (F.col("date") < F.col("test_end")), F.col("n"))
              .otherwise(0)).alias("n_test"))
    kept = f.join(cnt, "k", "left").na.fill({"n_train": 0, "n_test": 0}) \
        .filter((F.col("n_train") >= WF_MIN_TRAIN) & (F.col("n_test") >= WF_MIN_TEST))
    ranked = global_row_number(kept, ["k"], "fold")
    return ranked.select(F.col("fold").cast("int").alias("fold"), "train_start", "train_end", "test_start", "test_end",
                         "n_train", "n_test")


@query("walk_forward_fit", views=["prices"], sql=f"""
, {PREDS_SQL},
b AS (SELECT MIN(date) AS d0, MAX(date) AS d1 FROM preds),
c AS (SELECT date, COUNT(*) AS n FROM preds GROUP BY date),
f AS (SELECT k, CAST(d0 + INTERVAL ({WF_TRAIN_DAYS} + {WF_EMBARGO} + k * {WF_STEP}) DAY AS DATE) AS test_start
      FROM b, (SELECT unnest(range(0, greatest(date_diff('day', d0, d1) - ({WF_TRAIN_DAYS} + {WF_EMBARGO}), 0) // {WF_STEP} + 1)) AS k FROM b) ks),
f2 AS (SELECT k, test_start, CAST(test_start + INTERVAL {WF_TEST_DAYS} DAY AS DATE) AS test_end, CAST(test_start - INTERVAL {WF_EMBARGO} DAY AS DATE) AS train_end,
              CAST(test_start - INTERVAL ({WF_EMBARGO} + {WF_TRAIN_DAYS}) DAY AS DATE) AS train_start FROM f, b WHERE test_start <= d1),
cnt AS (SELECT k, train_start, train_end, test_start, test_end, COALESCE(SUM(n) FILTER (WHERE date < train_end), 0) AS n_train,
               COALESCE(SUM(n) FILTER (WHERE date >= test_start), 0) AS n_test
        FROM f2 LEFT JOIN c ON c.date >= train_start AND c.date < test_end GROUP BY 1, 2, 3, 4, 5),
kept AS (SELECT CAST(row_number() OVER (ORDER BY k) AS INTEGER) AS fold, * FROM cnt WHERE n_train >= {WF_MIN_TRAIN} AND n_test >= {WF_MIN_TEST}),
-- a model of one feature ranks by it, upwards if it goes with the target in training
up AS (SELECT fold, covar_pop(prob, target) >= 0 AS up FROM kept JOIN preds ON date >= train_start AND date < train_end GROUP BY fold),
r AS (SELECT fold, target, rank() OVER (PARTITION BY fold ORDER BY prob) AS rmin, COUNT(*) OVER (PARTITION BY fold, prob) AS c
      FROM kept JOIN preds ON date >= test_start AND date < test_end),
t AS (SELECT fold, SUM(target) AS npos, COUNT(*) - SUM(target) AS nneg, COUNT(*) AS n, SUM(rmin + (c - 1) / 2.0) FILTER (WHERE target = 1) AS rs FROM r GROUP BY fold),
a AS (SELECT fold, n, npos, (rs - npos * (npos + 1) / 2.0) / (npos * nneg) AS auc FROM t)
SELECT a.fold, CAST(n AS BIGINT) AS n_scored, CAST(npos AS BIGINT) AS n_positive, TRUE AS scored,
       round(CASE WHEN up THEN auc ELSE 1 - auc END, 6) AS fold_auc FROM a JOIN up ON a.fold = up.fold""")
def walk_forward_fit(spark, sf):
    """One logistic model a walk-forward fold, fitted on its training span
    behind the embargo and scored on its test span. The feature is the five
    days' momentum alone, so that an oracle knows each model's ranking."""
    p = cut_lineage(preds(spark, sf).select("ticker", "date", F.col("prob").alias("momentum"), "target"))
    folds = [r.asDict() for r in walk_forward_folds(spark, sf).collect()]  # as many as the calendar has steps
    s = TU.walk_forward_fit(p, folds, "date", "target", ML.logistic_pipeline(["momentum"], "target", c_inverse_reg=1e9).fit)
    return s.groupBy("fold").agg(F.count(F.lit(1)).alias("n_scored"), F.sum("target").cast("long").alias("n_positive"),
                                 F.min(F.coalesce(F.col("prob").between(0.0, 1.0), F.lit(False))).alias("scored"),
                                 r6(F.max("fold_auc")).alias("fold_auc"))


@query("expanding_folds", views=["prices"], sql=f"""
, {PREDS_SQL},
r AS (SELECT date, ticker, row_number() OVER (ORDER BY date, ticker) AS rn, COUNT(*) OVER () AS n FROM preds),
s AS (SELECT MAX(n) AS n, MAX(n) // 6 AS ts FROM r),
f AS (SELECT CAST(k AS INTEGER) AS fold, n - (5 - k + 1) * ts AS test_start_rn, ts FROM s, (SELECT unnest(range(1, 6)) AS k))
SELECT f.fold, CAST(f.test_start_rn AS BIGINT) AS n_train, CAST(f.ts AS BIGINT) AS n_test,
       MAX(r.date) FILTER (WHERE r.rn = f.test_start_rn) AS train_end_date,
       MAX(r.date) FILTER (WHERE r.rn = f.test_start_rn + 1) AS test_start_date
FROM f JOIN r ON r.rn IN (f.test_start_rn, f.test_start_rn + 1) GROUP BY f.fold, f.test_start_rn, f.ts""")
def expanding_folds(spark, sf):
    p = preds(spark, sf).select("date", "ticker")
    n = p.agg(F.count(F.lit(1))).scalar()
    ts = F.floor(n / 6)
    r = global_row_number(p, ["date", "ticker"], "rn")
    folds = r.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("fold"))
    folds = folds.select("fold", (n - (5 - F.col("fold") + 1) * ts).alias("tsr"), ts.alias("ts"))
    # the two rows at each fold's edge: an equality for either
    edges = folds.withColumn("rn", F.explode(F.array(F.col("tsr"), F.col("tsr") + 1)))
    j = r.join(edges, "rn")
    return j.groupBy("fold", "tsr", "ts").agg(
        F.max(F.when(F.col("rn") == F.col("tsr"), F.col("date"))).alias("train_end_date"),
        F.max(F.when(F.col("rn") == F.col("tsr") + 1, F.col("date"))).alias("test_start_date")) \
        .select("fold", F.col("tsr").cast("long").alias("n_train"), F.col("ts").cast("long").alias("n_test"),
                "train_end_date", "test_start_date")
