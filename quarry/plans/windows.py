"""Window / ordered queries (SURVEY section E)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.scalar import round_to, safe_divide
from quarry.operators import windows as W
from quarry.operators.ordered import global_row_number, grouped_running
from quarry.operators.rating import elo_ratings
from quarry.plans import views as V
from quarry.plans.catalog import query


def r6(c):
    return round_to(c, 6)


K, O = "ticker", "date"   # price key / order
_PW = "PARTITION BY ticker ORDER BY date"


def _roll_sql(x, n, m, agg="avg", current=True, part=_PW):
    frame = f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW" if current else \
        f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
    return (f"CASE WHEN count({x}) OVER ({part} {frame}) >= {m} "
            f"THEN {agg}({x}) OVER ({part} {frame}) END")


_LAGS = [1, 5, 10, 20, 60]


@query("lag_shift", views=["prices"], sql=f"""
SELECT ticker, date, {", ".join(f"round(lag(close, {k}) OVER ({_PW}), 6) AS close_lag{k}" for k in _LAGS)} FROM prices""")
def lag_shift(spark, sf):
    f, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=max(_LAGS))
    p = W.lag_cols(f, kk, oo, ["close"], _LAGS, "{c}_lag{k}").filter(own)
    return p.select(K, O, *[r6(F.col(f"close_lag{k}")).alias(f"close_lag{k}") for k in _LAGS])


@query("lead_target", views=["prices"], sql=f"""
SELECT ticker, date, round(ln(lead(close, 5) OVER ({_PW}) / close), 6) AS fwd_ret_5d,
       CASE WHEN lead(close, 5) OVER ({_PW}) IS NULL THEN NULL
            ELSE CAST(ln(lead(close, 5) OVER ({_PW}) / close) > 0 AS INTEGER) END AS target,
       COALESCE(CAST(ln(lead(close, 5) OVER ({_PW}) / close) > 0 AS INTEGER), 0) AS target_reference
FROM prices""")
def lead_target(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=0, forward=5)
    w = W._w(kk, oo)
    fwd = F.ln(safe_divide(F.lead("close", 5).over(w), F.col("close")))
    p = p.withColumn("_fwd", fwd).filter(own)
    fwd = F.col("_fwd")
    return p.select(K, O, r6(fwd).alias("fwd_ret_5d"),
                    F.when(fwd.isNotNull(), (fwd > 0).cast("int")).alias("target"),
                    F.coalesce((fwd > 0).cast("int"), F.lit(0)).alias("target_reference"))


@query("log_returns", views=["prices"], sql=f"""
SELECT ticker, date, {", ".join(f"round(ln(close / lag(close, {k}) OVER ({_PW})), 6) AS ret_{k}d" for k in _LAGS)},
       round(ln(close / lag(close, 5) OVER ({_PW})) - ln(close / lag(close, 20) OVER ({_PW})), 6) AS mom_accel
FROM prices""")
def log_returns(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=max(_LAGS))
    p = p.withColumns({f"_r{k}": W.log_return("close", kk, oo, k) for k in _LAGS}).filter(own)
    return p.select(K, O, *[r6(F.col(f"_r{k}")).alias(f"ret_{k}d") for k in _LAGS],
                    r6(F.col("_r5") - F.col("_r20")).alias("mom_accel"))


@query("pct_change", views=["prices"], sql=f"""
SELECT ticker, date, round(close / lag(close, 1) OVER ({_PW}) - 1, 6) AS pct_change FROM prices""")
def pct_change(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=1)
    return p.withColumn("_pc", W.pct_change("close", kk, oo)).filter(own) \
        .select(K, O, r6(F.col("_pc")).alias("pct_change"))


_GW = "PARTITION BY team_id ORDER BY game_date"


@query("rest_days", views=["games"], sql=f"""
SELECT team_id, game_date,
       least(COALESCE(date_diff('day', lag(game_date) OVER ({_GW}), game_date), 3), 10)::DOUBLE AS rest_days,
       CAST(least(COALESCE(date_diff('day', lag(game_date) OVER ({_GW}), game_date), 3), 10) <= 1 AS INTEGER) AS is_b2b
FROM games""")
def rest_days(spark, sf):
    g, kk, oo, own = W.keyed_frame(V.games(spark, sf), "team_id", "game_date", back=1)
    g = g.withColumn("_rd", W.rest_days("game_date", kk, oo)).filter(own)
    rd = F.col("_rd")
    return g.select("team_id", "game_date", rd.alias("rest_days"), (rd <= 1).cast("int").alias("is_b2b"))


@query("rolling_mean_minperiods", views=["games"], sql=f"""
SELECT team_id, game_date,
       round({_roll_sql('pts', 5, 3, current=False, part=_GW)}, 6) AS roll5_pts,
       round({_roll_sql('pts', 10, 5, current=False, part=_GW)}, 6) AS roll10_pts,
       round({_roll_sql('win', 20, 8, current=False, part=_GW)}, 6) AS roll20_win_pct
FROM games""")
def rolling_mean_minperiods(spark, sf):
    k, o = "team_id", "game_date"
    g, kk, oo, own = W.keyed_frame(V.games(spark, sf), k, o, back=20)
    g = g.withColumns({"_r5": W.rolling("pts", kk, oo, 5, 3, include_current=False),
                       "_r10": W.rolling("pts", kk, oo, 10, 5, include_current=False),
                       "_r20": W.rolling("win", kk, oo, 20, 8, include_current=False)}).filter(own)
    return g.select(k, o, r6(F.col("_r5")).alias("roll5_pts"), r6(F.col("_r10")).alias("roll10_pts"),
                    r6(F.col("_r20")).alias("roll20_win_pct"))


_RET1 = f"ln(close / lag(close, 1) OVER ({_PW}))"


@query("rolling_std", views=["prices"], sql=f"""
WITH r AS (SELECT ticker, date, {_RET1} AS ret_1d FROM prices),
v AS (SELECT ticker, date, {_roll_sql('ret_1d', 20, 20, 'stddev_samp')} * sqrt(252) AS vol_20d,
             {_roll_sql('ret_1d', 60, 60, 'stddev_samp')} * sqrt(252) AS vol_60d FROM r)
SELECT ticker, date, round(vol_20d, 6) AS vol_20d, round(vol_60d, 6) AS vol_60d,
       round(vol_20d / NULLIF(vol_60d, 0), 6) AS vol_ratio_rv FROM v""")
def rolling_std(spark, sf):
    """Realised volatility over 20 / 60 returns. Runs on the blocked view:
    windows over (ticker, block of 100k rows) with a 60-row halo, so a
    ticker with a third of all rows would still be spread over tasks."""
    b = W.blocked(V.prices(spark, sf), K, O, back=60, block_rows=100_000)
    kb = [K, "_blk"]
    p = b.withColumn("ret_1d", W.log_return("close", kb, "_idx", 1))
    v20 = W.rolling("ret_1d", kb, "_idx", 20, 20, "std") * math.sqrt(252)
    v60 = W.rolling("ret_1d", kb, "_idx", 60, 60, "std") * math.sqrt(252)
    p = p.withColumn("vol_20d", v20).withColumn("vol_60d", v60).filter("_own")
    return p.select(K, O, r6(F.col("vol_20d")).alias("vol_20d"), r6(F.col("vol_60d")).alias("vol_60d"),
                    r6(safe_divide(F.col("vol_20d"), F.col("vol_60d"))).alias("vol_ratio_rv"))


@query("rolling_max", views=["prices"], sql=f"""
SELECT ticker, date, round(close / ({_roll_sql('close', 252, 100, 'max')}), 6) AS price_52w_pct FROM prices""")
def rolling_max(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=251)
    p = p.withColumn("_m", W.rolling("close", kk, oo, 252, 100, "max")).filter(own)
    return p.select(K, O, r6(F.col("close") / F.col("_m")).alias("price_52w_pct"))


def _rsi_sql(n):
    return f"""(100 - 100 / (1 + ({_roll_sql('gain', n, n)}) / NULLIF({_roll_sql('loss', n, n)}, 0)))"""


@query("rsi", views=["prices"], sql=f"""
WITH d AS (SELECT ticker, date, close - lag(close) OVER ({_PW}) AS delta FROM prices),
g AS (SELECT ticker, date, CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS gain,
             CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS loss FROM d)
SELECT ticker, date, round({_rsi_sql(14)}, 6) AS rsi_14, round({_rsi_sql(7)}, 6) AS rsi_7 FROM g""")
def rsi(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=14)
    p = p.withColumns({"_r14": W.rsi("close", kk, oo, 14), "_r7": W.rsi("close", kk, oo, 7)}).filter(own)
    return p.select(K, O, r6(F.col("_r14")).alias("rsi_14"), r6(F.col("_r7")).alias("rsi_7"))


def _ema_sql(x, span, src_order=_PW, i="i"):
    """Closed-form EMA over a precomputed 0-based row index column ``i``."""
    a = 2.0 / (span + 1.0)
    r = 1.0 - a
    return (f"pow({r!r}, {i}) * sum(CASE WHEN {i} = 0 THEN {x} ELSE {a!r} * pow({r!r}, -{i}) * {x} END) "
            f"OVER ({src_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


_PI = f"(SELECT *, row_number() OVER ({_PW}) - 1 AS i FROM prices)"


@query("ema_recursive", views=["prices"], sql=f"""
SELECT ticker, date, round({_ema_sql('close', 12)}, 6) AS ema_12, round({_ema_sql('close', 26)}, 6) AS ema_26
FROM {_PI}""")
def ema_recursive(spark, sf):
    p, ix = W.row_index(V.prices(spark, sf), K, O)
    p = W.ema(p, "close", K, O, 12, "ema_12", ix)
    p = W.ema(p, "close", K, O, 26, "ema_26", ix)
    return p.select(K, O, r6(F.col("ema_12")).alias("ema_12"), r6(F.col("ema_26")).alias("ema_26"))


@query("macd", views=["prices"], sql=f"""
WITH e AS (SELECT ticker, date, close, i, {_ema_sql('close', 12)} - {_ema_sql('close', 26)} AS macd_line FROM {_PI}),
s AS (SELECT *, {_ema_sql('macd_line', 9)} AS macd_signal FROM e)
SELECT ticker, date, round(macd_line, 6) AS macd_line, round(macd_signal, 6) AS macd_signal,
       round((macd_line - macd_signal) / NULLIF(close, 0), 6) AS macd_hist,
       CAST(macd_line > macd_signal AS INTEGER) AS macd_cross FROM s""")
def macd(spark, sf):
    p, ix = W.row_index(V.prices(spark, sf), K, O)
    p = W.macd(p, "close", K, O, index=ix)
    return p.select(K, O, r6(F.col("macd_line")).alias("macd_line"), r6(F.col("macd_signal")).alias("macd_signal"),
                    r6(F.col("macd_hist")).alias("macd_hist"), "macd_cross")


@query("bollinger", views=["prices"], sql=f"""
WITH b AS (SELECT ticker, date, close, {_roll_sql('close', 20, 20)} AS sma,
                  {_roll_sql('close', 20, 20, 'stddev_samp')} AS sd FROM prices)
SELECT ticker, date, round((close - (sma - 2 * sd)) / NULLIF(4 * sd, 0), 6) AS bb_pct_b,
       round((4 * sd) / NULLIF(sma, 0), 6) AS bb_width FROM b""")
def bollinger(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=19)
    pb, width = W.bollinger("close", kk, oo, 20)
    p = p.withColumns({"_pb": pb, "_bw": width}).filter(own)
    return p.select(K, O, r6(F.col("_pb")).alias("bb_pct_b"), r6(F.col("_bw")).alias("bb_width"))


@query("atr", views=["prices"], sql=f"""
WITH t AS (SELECT ticker, date, close,
                  greatest(high - low, abs(high - lag(close) OVER ({_PW})), abs(low - lag(close) OVER ({_PW}))) AS tr
           FROM prices)
SELECT ticker, date, round(({_roll_sql('tr', 14, 14)}) / NULLIF(close, 0), 6) AS atr_14 FROM t""")
def atr(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=14)
    p = p.withColumn("_atr", W.atr("high", "low", "close", kk, oo, 14)).filter(own)
    return p.select(K, O, r6(F.col("_atr")).alias("atr_14"))


@query("volume_ratio", views=["prices"], sql=f"""
WITH v AS (SELECT ticker, date, volume, {_roll_sql('volume', 20, 10)} AS avg20,
                  {_roll_sql('volume', 5, 5)} AS avg5 FROM prices)
SELECT ticker, date, round(volume / NULLIF(avg20, 0), 6) AS vol_ratio,
       round(avg5 / NULLIF(avg20, 0), 6) AS vol_trend FROM v""")
def volume_ratio(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=19)
    p = p.withColumns({"_a20": W.rolling("volume", kk, oo, 20, 10), "_a5": W.rolling("volume", kk, oo, 5, 5)}).filter(own)
    avg20, avg5 = F.col("_a20"), F.col("_a5")
    return p.select(K, O, r6(safe_divide(F.col("volume"), avg20)).alias("vol_ratio"),
                    r6(safe_divide(avg5, avg20)).alias("vol_trend"))


@query("sma_deviation", views=["prices"], sql=f"""
WITH s AS (SELECT ticker, date, close, {_roll_sql('close', 20, 10)} AS s20, {_roll_sql('close', 50, 25)} AS s50,
                  {_roll_sql('close', 200, 100)} AS s200 FROM prices)
SELECT ticker, date, round((close - s20) / NULLIF(s20, 0), 6) AS pct_above_sma20,
       round((close - s50) / NULLIF(s50, 0), 6) AS pct_above_sma50,
       round((close - s200) / NULLIF(s200, 0), 6) AS pct_above_sma200,
       COALESCE(CAST(s20 > s50 AS INTEGER), 0) AS sma_20_50_cross FROM s""")
def sma_deviation(spark, sf):
    p, kk, oo, own = W.keyed_frame(V.prices(spark, sf), K, O, back=199)
    p = p.withColumns({f"_s{n}": W.rolling("close", kk, oo, n, m) for n, m in ((20, 10), (50, 25), (200, 100))}).filter(own)
    s20, s50, s200 = F.col("_s20"), F.col("_s50"), F.col("_s200")
    c = F.col("close")
    return p.select(K, O, r6(safe_divide(c - s20, s20)).alias("pct_above_sma20"),
                    r6(safe_divide(c - s50, s50)).alias("pct_above_sma50"),
                    r6(safe_divide(c - s200, s200)).alias("pct_above_sma200"),
                    F.coalesce((s20 > s50).cast("int"), F.lit(0)).alias("sma_20_50_cross"))


def _ewm_sql(x, span, minp, part, i="i"):
    r = 1.0 - 2.0 / (span + 1.0)
    fr = f"OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count({x}) {fr} >= {minp} THEN "
            f"sum(CASE WHEN {x} IS NOT NULL THEN pow({r!r}, -{i}) * {x} END) {fr} / "
            f"sum(CASE WHEN {x} IS NOT NULL THEN pow({r!r}, -{i}) END) {fr} END")


@query("ewm_adjusted", views=["games"], sql=f"""
WITH s AS (SELECT team_id, game_date, lag(pts) OVER ({_GW}) AS prev_pts, lag(win) OVER ({_GW}) AS prev_win,
                  row_number() OVER ({_GW}) - 1 AS i FROM games)
SELECT team_id, game_date, round({_ewm_sql('prev_pts', 10, 5, _GW)}, 6) AS ewm_pts,
       round({_ewm_sql('prev_win', 10, 5, _GW)}, 6) AS ewm_win_pct FROM s""")
def ewm_adjusted(spark, sf):
    k, o = "team_id", "game_date"
    g = V.games(spark, sf)
    g = W.lag_cols(g, k, o, ["pts", "win"], [1], "prev_{c}")
    g = W.ewm_adjusted(g, "prev_pts", k, o, 10, 5, "ewm_pts")
    g = W.ewm_adjusted(g, "prev_win", k, o, 10, 5, "ewm_win_pct")
    return g.select(k, o, r6(F.col("ewm_pts")).alias("ewm_pts"), r6(F.col("ewm_win_pct")).alias("ewm_win_pct"))


_MW = "PARTITION BY ticker ORDER BY date"


@query("market_context", views=["prices", "market_prices"], sql=f"""
WITH m AS (SELECT date, ln(close / lag(close, 5) OVER ({_MW})) AS mkt_ret_5d,
                  ln(close / lag(close, 20) OVER ({_MW})) AS mkt_ret_20d FROM market_prices)
SELECT p.ticker, p.date, round(m.mkt_ret_5d, 6) AS mkt_ret_5d, round(m.mkt_ret_20d, 6) AS mkt_ret_20d
FROM prices p LEFT JOIN m ON p.date = m.date""")
def market_context(spark, sf):
    m = V.market_prices(spark, sf)
    m = m.select(O, W.log_return("close", K, O, 5).alias("mkt_ret_5d"), W.log_return("close", K, O, 20).alias("mkt_ret_20d"))
    p = V.prices(spark, sf).select(K, O)
    # the market series has one row per calendar day: bounded, joined on date
    j = p.join(m, O, "left")
    return j.select(K, O, r6(F.col("mkt_ret_5d")).alias("mkt_ret_5d"), r6(F.col("mkt_ret_20d")).alias("mkt_ret_20d"))


_AW = "PARTITION BY patient_id ORDER BY appt_date, appt_id"


@query("expanding_prior_stats", views=["appointments"], sql=f"""
SELECT appt_id, patient_id,
       CAST(COALESCE(SUM(no_show) OVER ({_AW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior_noshows,
       COUNT(*) OVER ({_AW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_appts,
       round(COALESCE(SUM(no_show) OVER ({_AW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) * 1.0
             / NULLIF(COUNT(*) OVER ({_AW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0), 6) AS prior_noshow_rate
FROM appointments""")
def expanding_prior_stats(spark, sf):
    """Prior no-shows / appointments per patient via a grouped prefix scan
    (no per-patient window, so a dominant patient is split across tasks)."""
    a = V.appointments(spark, sf).select("appt_id", "patient_id", "appt_date", "no_show",
                                         F.lit(1).cast("long").alias("_one"))
    r = grouped_running(a, ["patient_id"], ["appt_date", "appt_id"],
                        {"prior_noshows": "no_show", "prior_appts": "_one"})
    s, n = F.col("prior_noshows").cast("long"), F.col("prior_appts")
    return r.select("appt_id", "patient_id", s.alias("prior_noshows"), n.alias("prior_appts"),
                    r6(F.coalesce(safe_divide(s, n), F.lit(0.0))).alias("prior_noshow_rate"))


@query("expanding_win_pct", views=["games"], sql=f"""
SELECT team_id, game_date,
       round(COALESCE(SUM(win) OVER ({_GW} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 1.0
             / greatest(row_number() OVER ({_GW}) - 1, 1), 6) AS season_win_pct,
       round(COALESCE(SUM(win) OVER (PARTITION BY team_id, season ORDER BY game_date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 1.0
             / greatest(row_number() OVER (PARTITION BY team_id, season ORDER BY game_date) - 1, 1), 6) AS season_win_pct_reset
FROM games""")
def expanding_win_pct(spark, sf):
    # prior wins / prior games per team (and per team-season) from the
    # grouped prefix scan: no per-team window
    g = V.games(spark, sf).select("team_id", "season", "game_date", "win", F.lit(1).cast("long").alias("_one"))
    a = grouped_running(g, ["team_id"], ["game_date"], {"_pw": "win", "_pn": "_one"})
    a = grouped_running(a, ["team_id", "season"], ["game_date"], {"_sw": "win", "_sn": "_one"})
    share = lambda w, n: r6(F.coalesce(F.col(w), F.lit(0)) / F.greatest(F.col(n), F.lit(1)))
    return a.select("team_id", "game_date", share("_pw", "_pn").alias("season_win_pct"),
                    share("_sw", "_sn").alias("season_win_pct_reset"))


@query("warmup_skip", views=["games"], sql=f"""
SELECT team_id, game_date, game_id FROM (
  SELECT team_id, game_date, game_id, row_number() OVER ({_GW}) AS rn FROM games) WHERE rn > 5""")
def warmup_skip(spark, sf):
    g = V.games(spark, sf).select("team_id", "game_date", "game_id", F.lit(1).cast("long").alias("_one"))
    r = grouped_running(g, ["team_id"], ["game_date"], {"_prior": "_one"})   # rows before this one
    return r.filter(F.col("_prior") >= 5).select("team_id", "game_date", "game_id")


@query("cross_section_zscore", views=["prices"], sql=f"""
WITH r AS (SELECT ticker, date, ln(close / lag(close, 5) OVER ({_PW})) AS ret_5d, volume FROM prices)
SELECT ticker, date,
       round((ret_5d - avg(ret_5d) OVER (PARTITION BY date)) / NULLIF(stddev_samp(ret_5d) OVER (PARTITION BY date), 0), 6) AS ret_5d,
       round((volume - avg(volume) OVER (PARTITION BY date)) / NULLIF(stddev_samp(volume) OVER (PARTITION BY date), 0), 6) AS volume
FROM r""")
def cross_section_zscore(spark, sf):
    p = V.prices(spark, sf).withColumn("ret_5d", W.log_return("close", K, O, 5)).select(K, O, "ret_5d", "volume")
    z = W.cross_section_zscore(p, O, ["ret_5d", "volume"])
    return z.select(K, O, r6(F.col("ret_5d")).alias("ret_5d"), r6(F.col("volume")).alias("volume"))


_QB_SQL = """
e AS (SELECT date, list_distinct(list_sort(quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])))
             AS edges FROM scored_events GROUP BY date),
b AS (SELECT s.id, s.date, s.score, s.label,
             CAST(greatest(len(list_filter(e.edges, lambda x: x < s.score)) - 1, 0) AS INTEGER) AS bucket
      FROM scored_events s JOIN e ON s.date = e.date)"""


@query("quantile_buckets", views=["scored_events"], sql=f"""
, {_QB_SQL}
SELECT id, date, bucket FROM b""")
def quantile_buckets(spark, sf):
    s = V.scored_events(spark, sf)
    return W.quantile_buckets(s, "date", "score", 10).select("id", "date", "bucket")


@query("top_bucket_return", views=["scored_events"], sql=f"""
, {_QB_SQL}
SELECT date, round(avg(score), 6) AS top_bucket_mean, COUNT(*) AS n FROM b WHERE bucket = 9 GROUP BY date""")
def top_bucket_return(spark, sf):
    s = V.scored_events(spark, sf)
    b = W.quantile_buckets(s, "date", "score", 10).filter(F.col("bucket") == 9)
    return b.groupBy("date").agg(r6(F.avg("score")).alias("top_bucket_mean"), F.count(F.lit(1)).alias("n"))


@query("rank_desc", views=["scored_events"], sql="""
SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scored_events""")
def rank_desc(spark, sf):
    s = V.scored_events(spark, sf).select("id", "score")
    return global_row_number(s, [("score", False), "id"], "rank").select("id", "rank")


@query("last_row_per_key", views=["prices"], sql="""
SELECT ticker, arg_max(date, date) AS date, round(arg_max(close, date), 6) AS close, arg_max(volume, date) AS volume
FROM prices GROUP BY ticker""")
def last_row_per_key(spark, sf):
    p = V.prices(spark, sf).select(K, O, "close", "volume")
    last = W.last_row_per_key(p, [K], [O])
    return last.select(K, O, r6(F.col("close")).alias("close"), "volume")


@query("last_n_per_key", views=["prices"], sql=f"""
WITH r AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM prices)
SELECT ticker, list(date ORDER BY date) AS dates, list(round(close, 6) ORDER BY date) AS closes
FROM r WHERE rn <= 20 GROUP BY ticker""")
def last_n_per_key(spark, sf):
    p = V.prices(spark, sf)
    top = W.top_n_per_key(p, [K], [F.col(O).desc()], 20, [O])
    g = top.groupBy(K).agg(F.sort_array(F.collect_list(F.struct(O, r6(F.col("close")).alias("c")))).alias("_s"))
    return g.select(K, F.col("_s.date").alias("dates"), F.col("_s.c").alias("closes"))


@query("last_12_months", views=["marketing"], sql="""
WITH mo AS (SELECT DISTINCT month FROM marketing ORDER BY month DESC LIMIT 12),
ch AS (SELECT DISTINCT channel FROM marketing),
agg AS (SELECT month, channel, SUM(spend) AS spend FROM marketing GROUP BY 1, 2),
grid AS (SELECT mo.month, ch.channel, round(COALESCE(agg.spend, 0), 2) AS spend
         FROM mo, ch LEFT JOIN agg ON agg.month = mo.month AND agg.channel = ch.channel)
SELECT channel, list(month ORDER BY month) AS months, list(spend ORDER BY month) AS spend FROM grid GROUP BY channel""")
def last_12_months(spark, sf):
    m = V.marketing(spark, sf)
    months = m.select("month").distinct().orderBy(F.desc("month")).limit(12)
    chans = m.select("channel").distinct()
    agg = m.groupBy("month", "channel").agg(F.sum("spend").alias("spend"))
    # dense (channel, month) grid: each channel expands the <= 12 latest
    # months, a bounded array computed once as a scalar subquery
    recent = months.agg(F.collect_list("month")).scalar()
    grid = chans.select("channel", F.explode(recent).alias("month"))
    grid = grid.join(agg, ["month", "channel"], "left") \
        .withColumn("spend", round_to(F.coalesce("spend", F.lit(0.0)), 2))
    g = grid.groupBy("channel").agg(F.sort_array(F.collect_list(F.struct("month", "spend"))).alias("_s"))
    return g.select("channel", F.col("_s.month").alias("months"), F.col("_s.spend").alias("spend"))


@query("price_snapshot", views=["prices"], sql="""
WITH r AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn,
                  COUNT(*) OVER (PARTITION BY ticker) AS n FROM prices)
SELECT ticker, round(MAX(close) FILTER (WHERE rn = 1), 6) AS last_price,
       round((MAX(close) FILTER (WHERE rn = 1) / MAX(close) FILTER (WHERE rn = least(6, n)) - 1) * 100, 6) AS chg_pct,
       list(round(close, 6) ORDER BY date) FILTER (WHERE rn <= 20) AS sparkline
FROM r GROUP BY ticker""")
def price_snapshot(spark, sf):
    p = V.prices(spark, sf)
    top = W.top_n_per_key(p, [K], [F.col(O).desc()], 20, [O])
    g = top.groupBy(K).agg(
        F.max(F.when(F.col("_rank") == 1, F.col("close"))).alias("_last"),
        F.max_by("close", F.when(F.col("_rank") <= 6, F.col("_rank"))).alias("_ref"),
        F.sort_array(F.collect_list(F.struct(O, r6(F.col("close")).alias("c")))).alias("_s"))
    return g.select(K, r6(F.col("_last")).alias("last_price"),
                    r6((F.col("_last") / F.col("_ref") - 1) * 100).alias("chg_pct"),
                    F.col("_s.c").alias("sparkline"))


# Oracle: the same replay as a recursive CTE, one step per game per league,
# ratings carried as a MAP (team -> rating).
ELO_SQL = """
, hg AS (SELECT league, game_id, game_date, team_abbr AS home, opponent_abbr AS away, win,
                row_number() OVER (PARTITION BY league ORDER BY game_date, game_id) AS k
         FROM games WHERE is_home = 1 AND win IS NOT NULL),
elo(league, k, ratings, game_id, game_date, home, away, h, a) AS (
  SELECT DISTINCT league, CAST(0 AS BIGINT), MAP([]::VARCHAR[], []::DOUBLE[]), NULL::VARCHAR, NULL::DATE,
         NULL::VARCHAR, NULL::VARCHAR, NULL::DOUBLE, NULL::DOUBLE FROM hg
  UNION ALL
  SELECT s.league, s.k, map_concat(s.ratings,
           MAP([s.home, s.away], [s.h + 20.0 * (s.win - s.e), s.a + 20.0 * ((1 - s.win) - (1 - s.e))])),
         s.game_id, s.game_date, s.home, s.away, s.h, s.a
  FROM (SELECT g.league, g.k, e0.ratings, g.game_id, g.game_date, g.home, g.away, g.win,
               COALESCE(e0.ratings[g.home], 1500.0) AS h, COALESCE(e0.ratings[g.away], 1500.0) AS a,
               1.0 / (1.0 + pow(10.0, (COALESCE(e0.ratings[g.away], 1500.0) - COALESCE(e0.ratings[g.home], 1500.0)) / 400.0)) AS e
        FROM elo e0 JOIN hg g ON g.league = e0.league AND g.k = e0.k + 1) s
)
SELECT game_id, game_date, home, away, round(h, 1) AS home_pre_elo, round(a, 1) AS away_pre_elo,
       round(h - a, 1) AS elo_diff FROM elo WHERE k > 0"""


@query("elo_ratings", views=["games"], sql=ELO_SQL, recursive=True)
def elo(spark, sf):
    g = V.games(spark, sf).filter((F.col("is_home") == 1) & F.col("win").isNotNull())
    home = g.select("league", "game_id", "game_date", F.col("team_abbr").alias("home"),
                    F.col("opponent_abbr").alias("away"), "win")
    e = elo_ratings(home)
    return e.select("game_id", "game_date", "home", "away", round_to("home_pre_elo", 1).alias("home_pre_elo"),
                    round_to("away_pre_elo", 1).alias("away_pre_elo"), round_to("elo_diff", 1).alias("elo_diff"))


@query("time_ordered_split", views=["appointments"], sql="""
SELECT appt_id, CASE WHEN row_number() OVER (ORDER BY appt_date, appt_id) <= floor(COUNT(*) OVER () * 0.8)
                     THEN 'train' ELSE 'test' END AS split FROM appointments""")
def time_ordered_split(spark, sf):
    a = V.appointments(spark, sf).select("appt_id", "appt_date")
    n = a.agg(F.count(F.lit(1))).scalar()
    r = global_row_number(a, ["appt_date", "appt_id"], "_rn")
    return r.select("appt_id", F.when(F.col("_rn") <= F.floor(n * 0.8), "train").otherwise("test").alias("split"))


@query("holdout_by_date", views=["prices"], sql="""
SELECT ticker, date, CAST(date >= CAST((SELECT MAX(date) FROM prices) - INTERVAL 6 MONTH AS DATE) AS INTEGER) AS is_holdout
FROM prices""")
def holdout_by_date(spark, sf):
    p = V.prices(spark, sf)
    cutoff = F.add_months(p.agg(F.max(O)).scalar(), -6)
    return p.select(K, O, (F.col(O) >= cutoff).cast("int").alias("is_holdout"))


_FLC = "(SELECT *, CAST(arr_delay >= 15 AS INTEGER) AS delayed FROM flights WHERE cancelled = 0 AND diverted = 0)"


@query("group_mean_encode", views=["flights"], sql=f"""
, fl AS {_FLC},
s AS (SELECT origin, SUM(delayed) AS s, COUNT(*) AS n FROM fl GROUP BY origin)
SELECT fl.order_id, fl.leg, round(s.s * 1.0 / s.n, 6) AS origin_delay_rate,
       round(CASE WHEN s.n > 1 THEN (s.s - fl.delayed) * 1.0 / (s.n - 1) ELSE s.s * 1.0 / s.n END, 6) AS origin_rate_loo
FROM fl JOIN s ON fl.origin = s.origin""")
def group_mean_encode(spark, sf):
    f = V.flights(spark, sf).filter((F.col("cancelled") == 0) & (F.col("diverted") == 0)) \
        .withColumn("delayed", (F.col("arr_delay") >= 15).cast("int"))
    e = W.group_mean_encode(f, "origin", "delayed", "origin_delay_rate")
    e = W.group_mean_encode(e, "origin", "delayed", "origin_rate_loo", leave_one_out=True)
    return e.select("order_id", "leg", r6(F.col("origin_delay_rate")).alias("origin_delay_rate"),
                    r6(F.col("origin_rate_loo")).alias("origin_rate_loo"))
