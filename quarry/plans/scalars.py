"""Scalar-function queries (SURVEY section H): string, date, bins, math,
odds, bets, arrays, maps, JSON access. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.sources.tables import read_table


def r6(c):
    return S.round_to(c, 6)


@query("str_concat_key", views=["flights"], sql="""
SELECT DISTINCT origin || '_' || dest AS route_key FROM flights""")
def str_concat_key(spark, sf):
    return V.flights(spark, sf).select(F.concat_ws("_", "origin", "dest").alias("route_key")).distinct()


@query("str_replace_chain", sql="""
SELECT p_partkey, replace(p_brand, '#', '→') AS brand_label,
       regexp_replace(p_name, '^(small |large )', '') AS name_stripped,
       replace(CAST(p_retailprice AS VARCHAR), '.', '-') AS price_dashed
FROM part""")
def str_replace_chain(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_name", "p_retailprice"])
    return p.select("p_partkey", F.replace("p_brand", F.lit("#"), F.lit("→")).alias("brand_label"),
                    S.strip_prefixes("p_name", ["small ", "large "]).alias("name_stripped"),
                    F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit("-")).alias("price_dashed"))


@query("str_parse_matchup", views=["games"], sql="""
SELECT game_id, team_abbr, CAST(contains(matchup, 'vs.') AS INTEGER) AS parsed_home,
       COALESCE(list_filter(regexp_split_to_array(matchup, '\\s+(vs\\.|@)\\s+'), lambda p: trim(p) <> team_abbr)[1],
                'UNK') AS parsed_opponent
FROM games""")
def str_parse_matchup(spark, sf):
    g = V.games(spark, sf)
    home, opp = S.parse_matchup("matchup", F.col("team_abbr"))
    return g.select("game_id", "team_abbr", home.alias("parsed_home"), opp.alias("parsed_opponent"))


@query("str_prefix_tests", sql="""
SELECT p_partkey, CAST(starts_with(p_type, 'SM') OR starts_with(p_type, 'LA') AS INTEGER) AS size_type,
       substr(p_brand, 6) AS after5, CAST(contains(p_name, 'red') AS INTEGER) AS is_red
FROM part""")
def str_prefix_tests(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_type", "p_brand", "p_name"])
    return p.select("p_partkey", (F.col("p_type").startswith("SM") | F.col("p_type").startswith("LA"))
                    .cast("int").alias("size_type"),
                    F.substring("p_brand", 6, 1 << 20).alias("after5"),
                    F.col("p_name").contains("red").cast("int").alias("is_red"))


@query("str_format_narrative", views=["marketing"], sql="""
WITH c AS (SELECT channel, round(SUM(spend), 2) AS spend, round(SUM(revenue_attributed) * 100.0 / SUM(spend), 1) AS pct
           FROM marketing GROUP BY channel)
SELECT channel, 'Spend $' || format('{:,.2f}', spend) || ' returned ' || printf('%.1f', pct) || '% of spend.' AS sentence
FROM c""")
def str_format_narrative(spark, sf):
    c = V.marketing(spark, sf).groupBy("channel").agg(
        S.round_to(F.sum("spend"), 2).alias("spend"),
        S.round_to(F.sum("revenue_attributed") * 100.0 / F.sum("spend"), 1).alias("pct"))
    return c.select("channel", F.concat(F.lit("Spend $"), F.format_number("spend", 2), F.lit(" returned "),
                                        F.format_string("%.1f", "pct"), F.lit("% of spend.")).alias("sentence"))


_DATE_TEXT = """CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%b %d, %Y')
                                 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
                                 ELSE strftime(o_orderdate, '%m/%d/%Y') END"""


@query("date_parse_multi", sql=f"""
WITH t AS (SELECT o_orderkey, {_DATE_TEXT} AS txt, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, txt, COALESCE(CAST(try_strptime(txt, '%b %d, %Y') AS DATE), CAST(try_strptime(txt, '%Y-%m-%d') AS DATE),
                                 CAST(try_strptime(txt, '%m/%d/%Y') AS DATE)) AS parsed,
       d AS expected FROM t""")
def date_parse_multi(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    k = F.col("o_orderkey") % 3
    txt = (F.when(k == 0, F.date_format("o_orderdate", "MMM dd, yyyy"))
            .when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")))
    o = o.withColumn("txt", txt)
    return o.select("o_orderkey", "txt", S.parse_date_multi("txt").alias("parsed"),
                    F.to_date("o_orderdate").alias("expected"))


@query("date_parts", views=["appointments"], sql="""
SELECT appt_id, CAST(month(appt_date) AS INTEGER) AS month, CAST(year(appt_date) AS INTEGER) AS year,
       CAST(isodow(appt_date) - 1 AS INTEGER) AS weekday, CAST((appt_id % 2400) // 100 AS INTEGER) AS hour
FROM appointments""")
def date_parts(spark, sf):
    a = V.appointments(spark, sf)
    return a.select("appt_id", F.month("appt_date").alias("month"), F.year("appt_date").alias("year"),
                    S.weekday_mon0("appt_date").alias("weekday"), S.hhmm_hour(F.col("appt_id") % 2400).alias("hour"))


@query("date_periods", views=["appointments"], sql="""
SELECT appt_id, strftime(appt_date, '%Y-%m') AS month_label,
       CAST(year(appt_date) AS VARCHAR) || 'Q' || CAST(quarter(appt_date) AS VARCHAR) AS quarter_label
FROM appointments""")
def date_periods(spark, sf):
    a = V.appointments(spark, sf)
    return a.select("appt_id", S.month_label("appt_date").alias("month_label"),
                    S.quarter_label("appt_date").alias("quarter_label"))


@query("date_arithmetic", views=["appointments"], sql="""
SELECT appt_id, CAST(appt_date + INTERVAL 6 MONTH AS DATE) AS plus_6m, CAST(appt_date - INTERVAL 30 DAY AS DATE) AS minus_30d,
       CAST(date_diff('day', appt_date, DATE '2002-01-01') AS INTEGER) AS days_to_2002
FROM appointments""")
def date_arithmetic(spark, sf):
    a = V.appointments(spark, sf)
    # add_months clamps to the month end like a calendar offset
    return a.select("appt_id", F.add_months("appt_date", 6).alias("plus_6m"),
                    F.date_sub("appt_date", 30).alias("minus_30d"),
                    F.datediff(F.lit("2002-01-01").cast("date"), F.col("appt_date")).alias("days_to_2002"))


@query("date_from_month_text", views=["marketing"], sql="""
SELECT month, channel, CAST(strptime(month || '-01', '%Y-%m-%d') AS DATE) AS month_start FROM marketing""")
def date_from_month_text(spark, sf):
    m = V.marketing(spark, sf)
    return m.select("month", "channel", S.date_from_month_text("month").alias("month_start"))


@query("bin_cut", views=["flights"], sql="""
SELECT CASE WHEN distance > 0 AND distance <= 500 THEN 0 WHEN distance > 500 AND distance <= 1000 THEN 1
            WHEN distance > 1000 AND distance <= 1500 THEN 2 WHEN distance > 1500 AND distance <= 2000 THEN 3
            WHEN distance > 2000 AND distance <= 5000 THEN 4 END AS dist_bin, COUNT(*) AS n
FROM flights GROUP BY 1""")
def bin_cut(spark, sf):
    f = V.flights(spark, sf)
    return f.groupBy(S.bin_cut("distance", [0, 500, 1000, 1500, 2000, 5000]).alias("dist_bin")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("bin_floor", views=["flights"], sql="""
SELECT CAST(least(floor(distance / 500), 4) AS INTEGER) AS dist_bin, COUNT(*) AS n FROM flights GROUP BY 1""")
def bin_floor(spark, sf):
    f = V.flights(spark, sf)
    return f.groupBy(S.bin_floor("distance", 500, 4).alias("dist_bin")).agg(F.count(F.lit(1)).alias("n"))


@query("math_core", sql="""
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS ln_price, round(pow(10, l_discount), 6) AS pow10,
       round(sqrt(l_quantity), 6) AS sqrt_qty, abs(l_tax - 0.04) AS abs_dev,
       CAST(floor(l_quantity / 7) AS BIGINT) AS qty_div7, -l_discount AS neg_discount
FROM lineitem""")
def math_core(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                                             "l_quantity", "l_tax"])
    return li.select("l_orderkey", "l_linenumber", r6(F.ln("l_extendedprice")).alias("ln_price"),
                     r6(F.pow(F.lit(10.0), F.col("l_discount"))).alias("pow10"),
                     r6(F.sqrt("l_quantity")).alias("sqrt_qty"), F.abs(F.col("l_tax") - 0.04).alias("abs_dev"),
                     F.floor(F.col("l_quantity") / 7).cast("long").alias("qty_div7"),
                     (-F.col("l_discount")).alias("neg_discount"))


@query("odds_to_probability", views=["odds"], sql="""
SELECT poll_id, round(CASE WHEN home_ml >= 0 THEN 100.0 / (home_ml + 100.0) ELSE abs(home_ml) / (abs(home_ml) + 100.0) END, 6) AS home_implied,
       round(CASE WHEN away_ml >= 0 THEN 100.0 / (away_ml + 100.0) ELSE abs(away_ml) / (abs(away_ml) + 100.0) END, 6) AS away_implied
FROM odds""")
def odds_to_probability(spark, sf):
    o = V.odds(spark, sf)
    return o.select("poll_id", r6(S.odds_to_probability("home_ml")).alias("home_implied"),
                    r6(S.odds_to_probability("away_ml")).alias("away_implied"))


def _implied_sql(c):
    return f"CASE WHEN {c} >= 0 THEN 100.0 / ({c} + 100.0) ELSE abs({c}) / (abs({c}) + 100.0) END"


@query("vig_removal_edge", views=["odds"], sql=f"""
WITH i AS (SELECT poll_id, {_implied_sql('home_ml')} AS hi, {_implied_sql('away_ml')} AS ai,
                  0.35 + (poll_id % 30) / 100.0 AS model_home FROM odds),
n AS (SELECT poll_id, model_home, hi / (hi + ai) AS home_fair FROM i)
SELECT poll_id, round(home_fair, 6) AS home_fair,
       round(CASE WHEN model_home - home_fair = 0 THEN NULL ELSE model_home - home_fair END, 6) AS home_edge,
       CASE WHEN model_home - home_fair >= 0.05 THEN 'home'
            WHEN (1 - model_home) - (1 - home_fair) >= 0.05 THEN 'away' ELSE 'none' END AS pick
FROM n""")
def vig_removal_edge(spark, sf):
    o = V.odds(spark, sf)
    hi, ai = S.odds_to_probability("home_ml"), S.odds_to_probability("away_ml")
    model = F.lit(0.35) + (F.col("poll_id") % 30) / 100.0
    fair = hi / (hi + ai)
    edge = model - fair
    pick = (F.when(edge >= 0.05, "home").when((1 - model) - (1 - fair) >= 0.05, "away").otherwise("none"))
    return o.select("poll_id", r6(fair).alias("home_fair"),
                    r6(F.when(edge == 0, None).otherwise(edge)).alias("home_edge"), pick.alias("pick"))


@query("payout_breakeven", views=["odds"], sql="""
SELECT poll_id, round(CASE WHEN home_ml > 0 THEN home_ml ELSE 10000.0 / abs(home_ml) END, 6) AS profit_per_100,
       round(100.0 / (CASE WHEN home_ml > 0 THEN home_ml ELSE 10000.0 / abs(home_ml) END + 100.0), 6) AS breakeven
FROM odds""")
def payout_breakeven(spark, sf):
    o = V.odds(spark, sf)
    return o.select("poll_id", r6(S.profit_per_unit("home_ml")).alias("profit_per_100"),
                    r6(S.breakeven_probability("home_ml")).alias("breakeven"))


_BET_SQL = """
bt AS (
  SELECT g.game_id, g.game_date, g.win AS home_win,
         0.5 + (COALESCE(sh.wp, 0.5) - COALESCE(sa.wp, 0.5)) / 2 AS p_home,
         CASE WHEN g.team_id % 2 = 0 THEN -130.0 ELSE 115.0 END AS home_ml
  FROM games g
  LEFT JOIN (SELECT season, team_abbr, SUM(win) * 1.0 / COUNT(*) AS wp FROM games GROUP BY 1, 2) sh
         ON sh.team_abbr = g.team_abbr AND sh.season = CAST(CAST(g.season AS INTEGER) - 1 AS VARCHAR)
  LEFT JOIN (SELECT season, team_abbr, SUM(win) * 1.0 / COUNT(*) AS wp FROM games GROUP BY 1, 2) sa
         ON sa.team_abbr = g.opponent_abbr AND sa.season = CAST(CAST(g.season AS INTEGER) - 1 AS VARCHAR)
  WHERE g.is_home = 1),
bets AS (
  SELECT *, CASE WHEN p_home >= 0.5 THEN 'home' ELSE 'away' END AS side,
         greatest(p_home, 1 - p_home) AS p_side,
         CASE WHEN p_home >= 0.5 THEN home_win ELSE 1 - home_win END AS side_won,
         CASE WHEN p_home >= 0.5 THEN (CASE WHEN home_ml > 0 THEN home_ml ELSE 10000.0 / abs(home_ml) END)
              ELSE 90.9090909090909 END AS side_profit
  FROM bt),
placed AS (
  SELECT *, CASE WHEN p_side >= 0.55 THEN 1 ELSE 0 END AS bet_a,
         CASE WHEN side_won = 1 THEN side_profit ELSE -100.0 END AS pnl FROM bets)"""


def _bets(spark, sf):
    """Scored games with a bet decision: model prob = 0.5 + half the gap of
    last season's win shares; side = the likelier team (tie -> home)."""
    g = V.games(spark, sf)
    st = g.groupBy("season", "team_abbr").agg((F.sum("win") / F.count(F.lit(1))).alias("wp"))
    prev = st.select((F.col("season").cast("int") + 1).cast("string").alias("season"), "team_abbr", "wp")
    h = g.filter(F.col("is_home") == 1)
    h = h.join(prev.withColumnRenamed("wp", "wp_h"), ["season", "team_abbr"], "left")
    h = h.join(prev.withColumnRenamed("team_abbr", "opponent_abbr").withColumnRenamed("wp", "wp_a"),
               ["season", "opponent_abbr"], "left")
    p_home = F.lit(0.5) + (F.coalesce("wp_h", F.lit(0.5)) - F.coalesce("wp_a", F.lit(0.5))) / 2
    home_ml = F.when(F.col("team_id") % 2 == 0, -130.0).otherwise(115.0)
    b = h.select("game_id", "game_date", F.col("win").alias("home_win"), p_home.alias("p_home"),
                 home_ml.alias("home_ml"))
    home_side = F.col("p_home") >= 0.5
    b = b.withColumn("side", F.when(home_side, "home").otherwise("away")) \
         .withColumn("p_side", F.greatest("p_home", 1 - F.col("p_home"))) \
         .withColumn("side_won", F.when(home_side, F.col("home_win")).otherwise(1 - F.col("home_win"))) \
         .withColumn("side_profit", F.when(home_side, S.profit_per_unit("home_ml")).otherwise(F.lit(90.9090909090909)))
    return b.withColumn("bet_a", (F.col("p_side") >= 0.55).cast("int")) \
            .withColumn("pnl", F.when(F.col("side_won") == 1, F.col("side_profit")).otherwise(-100.0))


@query("bet_simulation", views=["games"], sql=f"""
, {_BET_SQL}
SELECT game_id, side, round(p_side, 6) AS p_side, bet_a, CASE WHEN round(edge, 6) >= 0.04 THEN 1 ELSE 0 END AS bet_b,
       round(edge, 6) + 0.0 AS edge, round(pnl, 6) AS pnl
FROM (SELECT *, p_side - CASE WHEN side = 'away' THEN 110.0 / 210 WHEN home_ml > 0 THEN 100.0 / (home_ml + 100)
                              ELSE abs(home_ml) / (abs(home_ml) + 100) END AS edge FROM placed)""")
def bet_simulation(spark, sf):
    """Strategy A bets on a likely side, strategy B on an edge of 0.04 over the price's break-even."""
    fair = F.when(F.col("side") == "away", 110.0 / 210).otherwise(S.breakeven_probability("home_ml"))
    b = _bets(spark, sf).withColumn("edge", r6(F.col("p_side") - fair))
    return b.select("game_id", "side", r6(F.col("p_side")).alias("p_side"), "bet_a", (F.col("edge") >= 0.04).cast("int").alias("bet_b"),
                    "edge", r6(F.col("pnl")).alias("pnl"))


@query("array_build_slice", views=["prices"], sql="""
WITH a AS (SELECT ticker, list(round(close, 6) ORDER BY date) AS closes FROM prices GROUP BY ticker)
SELECT ticker, closes[-5:] AS last5, closes[1:3] AS first3,
       list_filter(closes, lambda x, i: (i - 1) % 100 = 0) AS every100 FROM a""")
def array_build_slice(spark, sf):
    """Ordered arrays per ticker: last 5, first 3 and every 100th close.
    Positions come from a per-ticker row number (one bar per day, so
    calendar-bounded) and only the selected elements are collected."""
    from pyspark.sql import Window
    p = V.prices(spark, sf).select("ticker", "date", S.round_to("close", 6).alias("c"))
    w = Window.partitionBy("ticker")
    p = p.withColumn("i", F.row_number().over(w.orderBy("date")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    keep = p.filter((F.col("i") < 3) | (F.col("i") >= F.col("n") - 5) | (F.col("i") % 100 == 0))

    def ordered(cond):
        return F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("i", "c")))), lambda x: x["c"])
    return keep.groupBy("ticker").agg(ordered(F.col("i") >= F.col("n") - 5).alias("last5"),
                                      ordered(F.col("i") < 3).alias("first3"),
                                      ordered(F.col("i") % 100 == 0).alias("every100"))


@query("map_build", views=["payer"], sql="""
WITH c AS (SELECT state, code, round(avg(payment), 2) AS avg_payment FROM payer GROUP BY 1, 2)
SELECT state, map_from_entries(list(struct_pack(k := code, v := avg_payment) ORDER BY code)) AS by_code FROM c
GROUP BY state""")
def map_build(spark, sf):
    c = V.payer(spark, sf).groupBy("state", "code").agg(S.round_to(F.avg("payment"), 2).alias("avg_payment"))
    # entries in key order so the map is the same whatever order rows arrive in
    return c.groupBy("state").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "avg_payment")))).alias("by_code"))


@query("json_access_default", sql="""
SELECT event_id, COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), -1) AS k,
       COALESCE(json_extract_string(props, '$.missing'), 'none') AS missing FROM events""")
def json_access_default(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "props"])
    return e.select("event_id", F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(-1)).alias("k"),
                    F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"))


@query("null_nan_guard", views=["prices"], sql="""
SELECT ticker, date, round(COALESCE(ln(close / lag(close, 60) OVER (PARTITION BY ticker ORDER BY date)), 0.0), 6) AS ret_60d
FROM prices""")
def null_nan_guard(spark, sf):
    from quarry.operators.windows import log_return
    p = V.prices(spark, sf)
    return p.select("ticker", "date", r6(S.nan_guard(log_return("close", "ticker", "date", 60))).alias("ret_60d"))
