"""Join queries (SURVEY section C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalar import round_to
from quarry.operators import joins as J
from quarry.operators import windows as W
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.sources.tables import read_table


def r6(c):
    return round_to(c, 6)


def r2(c):
    return round_to(c, 2)


@query("left_join", views=["appointments", "patients"], sql="""
SELECT p.patient_id, p.channel, COALESCE(a.n_appts, 0) AS n_appts, COALESCE(a.n_noshow, 0) AS n_noshow
FROM patients p LEFT JOIN (SELECT patient_id, COUNT(*) AS n_appts, CAST(SUM(no_show) AS BIGINT) AS n_noshow
                           FROM appointments GROUP BY patient_id) a ON p.patient_id = a.patient_id""")
def left_join(spark, sf):
    a = V.appointments(spark, sf).groupBy("patient_id").agg(F.count(F.lit(1)).alias("n_appts"),
                                                           F.sum("no_show").cast("long").alias("n_noshow"))
    p = V.patients(spark, sf).select("patient_id", "channel")
    return J.align_to_keys(p, a, ["patient_id"], {"n_appts": 0, "n_noshow": 0})


@query("inner_join_multikey", views=["games"], sql="""
SELECT h.game_id, h.game_date, h.season, h.team_abbr AS home_team, a.team_abbr AS away_team,
       h.pts AS home_pts, a.pts AS away_pts, h.win AS home_win
FROM games h JOIN games a ON h.game_id = a.game_id AND h.game_date = a.game_date AND h.season = a.season
WHERE h.is_home = 1 AND a.is_home = 0""")
def inner_join_multikey(spark, sf):
    g = V.games(spark, sf)
    keys = ["game_id", "game_date", "season"]
    h = g.filter(F.col("is_home") == 1).select(*keys, F.col("team_abbr").alias("home_team"),
                                               F.col("pts").alias("home_pts"), F.col("win").alias("home_win"))
    a = g.filter(F.col("is_home") == 0).select(*keys, F.col("team_abbr").alias("away_team"),
                                               F.col("pts").alias("away_pts"))
    return h.join(a, keys).select(*keys, "home_team", "away_team", "home_pts", "away_pts", "home_win")


@query("self_join_theta", views=["games"], sql="""
SELECT a.game_id, a.team_id, a.pts, b.pts AS opp_pts_joined
FROM games a LEFT JOIN games b ON a.game_id = b.game_id AND a.team_id <> b.team_id""")
def self_join_theta(spark, sf):
    g = V.games(spark, sf).select("game_id", "team_id", "pts").alias("a")
    b = V.games(spark, sf).select("game_id", "team_id", "pts").alias("b")
    # equi part (game_id) hashes; the <> is a residual on exactly two rows per game
    j = g.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a.team_id") != F.col("b.team_id")), "left")
    return j.select(F.col("a.game_id").alias("game_id"), F.col("a.team_id").alias("team_id"),
                    F.col("a.pts").alias("pts"), F.col("b.pts").alias("opp_pts_joined"))


@query("dimension_join", views=["prices", "tickers"], sql="""
SELECT p.ticker, p.date, t.sector, round(p.close, 6) AS close
FROM prices p JOIN tickers t ON p.ticker = t.ticker WHERE t.is_etf = 0""")
def dimension_join(spark, sf):
    t = V.tickers(spark, sf).filter(F.col("is_etf") == 0)
    # the ticker list is one row per brand: bounded, broadcast
    j = V.prices(spark, sf).join(t, "ticker")
    return j.select("ticker", "date", "sector", r6(F.col("close")).alias("close"))


_STANDINGS = """st AS (SELECT season, team_abbr, SUM(win) * 1.0 / COUNT(*) AS win_pct FROM games GROUP BY 1, 2)"""


@query("map_join_default", views=["games"], sql=f"""
, {_STANDINGS}
SELECT g.game_id, g.team_id, round(COALESCE(st.win_pct, 0.5), 6) AS opp_prev_win_pct
FROM games g LEFT JOIN st ON st.team_abbr = g.opponent_abbr
                         AND st.season = CAST(CAST(g.season AS INTEGER) - 1 AS VARCHAR)""")
def map_join_default(spark, sf):
    g = V.games(spark, sf)
    st = g.groupBy("season", "team_abbr").agg((F.sum("win") / F.count(F.lit(1))).alias("_wp"))
    st = st.select((F.col("season").cast("int") + 1).cast("string").alias("season"),
                   F.col("team_abbr").alias("opponent_abbr"), "_wp")
    j = g.join(st, ["season", "opponent_abbr"], "left")
    return j.select("game_id", "team_id", r6(F.coalesce("_wp", F.lit(0.5))).alias("opp_prev_win_pct"))


@query("timeseries_join", views=["prices", "market_prices"], sql="""
SELECT p.ticker, p.date, round(m.close, 6) AS market_close
FROM prices p LEFT JOIN market_prices m ON p.date = m.date""")
def timeseries_join(spark, sf):
    m = V.market_prices(spark, sf).select("date", F.col("close").alias("market_close"))
    j = V.prices(spark, sf).select("ticker", "date").join(m, "date", "left")
    return j.select("ticker", "date", r6(F.col("market_close")).alias("market_close"))


@query("sector_context_join", views=["prices", "tickers", "sector_prices"], sql=f"""
WITH sr AS (SELECT ticker AS sector, date, ln(close / lag(close, 5) OVER (PARTITION BY ticker ORDER BY date)) AS r5
            FROM sector_prices)
SELECT p.ticker, p.date, t.sector, round(sr.r5, 6) AS sector_ret_5d
FROM prices p JOIN tickers t ON p.ticker = t.ticker LEFT JOIN sr ON sr.sector = t.sector AND sr.date = p.date""")
def sector_context_join(spark, sf):
    sr = V.sector_prices(spark, sf)
    sr = sr.select(F.col("ticker").alias("sector"), "date", W.log_return("close", "ticker", "date", 5).alias("_r5"))
    p = V.prices(spark, sf).select("ticker", "date").join(V.tickers(spark, sf).select("ticker", "sector"),
                                                           "ticker")
    # long sector-return table joined on (sector, date), never wide columns
    j = p.join(sr, ["sector", "date"], "left")
    return j.select("ticker", "date", "sector", r6(F.col("_r5")).alias("sector_ret_5d"))


@query("semi_join", views=["appointments"], sql="""
SELECT a.appt_id, a.patient_id FROM appointments a
WHERE a.patient_id IN (SELECT patient_id FROM appointments GROUP BY patient_id HAVING year(MIN(appt_date)) = 1995)""")
def semi_join(spark, sf):
    a = V.appointments(spark, sf)
    cohort = a.groupBy("patient_id").agg(F.min("appt_date").alias("_f")).filter(F.year("_f") == 1995)
    return a.join(cohort, "patient_id", "left_semi").select("appt_id", "patient_id")


@query("asof_latest_before", views=["shop_orders", "games"], sql="""
SELECT o.order_id, g.game_date AS last_game_date, g.pts AS last_game_pts
FROM shop_orders o ASOF LEFT JOIN games g ON o.state = g.team_abbr AND o.order_date > g.game_date""")
def asof_latest_before(spark, sf):
    o = V.shop_orders(spark, sf).select("order_id", "state", "order_date")
    g = V.games(spark, sf).select(F.col("team_abbr").alias("state"), "game_date", "pts")
    j = J.asof_latest_before(o, ["order_id"], g, "state", "order_date", "game_date", ["pts"], method="scan")
    return j.select("order_id", F.col("asof._t").alias("last_game_date"), F.col("asof.pts").alias("last_game_pts"))


@query("latest_snapshot_join", views=["odds"], sql="""
SELECT fetch_date, home_team, away_team, arg_max(home_ml, (fetched_at, poll_id)) AS home_ml,
       arg_max(away_ml, (fetched_at, poll_id)) AS away_ml
FROM odds GROUP BY fetch_date, home_team, away_team""")
def latest_snapshot_join(spark, sf):
    o = V.odds(spark, sf)
    g = o.groupBy("fetch_date", "home_team", "away_team").agg(
        F.max_by(F.struct("home_ml", "away_ml"), F.struct("fetched_at", "poll_id")).alias("_q"))
    return g.select("fetch_date", "home_team", "away_team", F.col("_q.home_ml").alias("home_ml"),
                    F.col("_q.away_ml").alias("away_ml"))


@query("cross_join_pairs", sql="""
SELECT a.n_name AS home, b.n_name AS away FROM nation a JOIN nation b ON a.n_name <> b.n_name""")
def cross_join_pairs(spark, sf):
    n = read_table(spark, sf, "nation", ["n_name"])   # fixed 25-row team list
    return J.ordered_pairs(n, "n_name")


_FULL_NAME = ("CASE WHEN user_id % 2 = 0 THEN 'The Nation ' || CAST(user_id % 25 AS VARCHAR) || ' Club' "
              "ELSE 'Club ' || CAST(user_id % 25 AS VARCHAR) END")


@query("fuzzy_name_join", sql=f"""
WITH names AS (SELECT event_id AS poll_id, {_FULL_NAME} AS full_name FROM events),
d AS (SELECT n_name AS code, 'nation ' || CAST(n_nationkey AS VARCHAR) AS dname, n_nationkey AS ord FROM nation),
dn AS (SELECT DISTINCT full_name FROM names),
c AS (SELECT dn.full_name, d.code, d.ord,
             CASE WHEN contains(lower(dn.full_name), lower(d.code)) OR contains(lower(dn.full_name), d.dname)
                  THEN 1 ELSE 2 END AS rule
      FROM dn JOIN d ON contains(lower(dn.full_name), lower(d.code)) OR contains(lower(dn.full_name), d.dname)
          OR len(list_filter(string_split_regex(lower(dn.full_name), '\\s+'),
                             lambda w: len(w) > 0 AND contains(d.dname, w))) > 0),
b AS (SELECT full_name, arg_min(code, rule * 1000 + ord) AS matched_code FROM c GROUP BY full_name)
SELECT names.poll_id, names.full_name, b.matched_code FROM names LEFT JOIN b ON names.full_name = b.full_name""")
def fuzzy_name_join(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "user_id"])
    k = (F.col("user_id") % 25).cast("string")
    names = e.select(F.col("event_id").alias("poll_id"),
                     F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("The Nation "), k, F.lit(" Club")))
                      .otherwise(F.concat(F.lit("Club "), k)).alias("full_name"))
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    dim = n.select("n_name", F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("dname"),
                   "n_nationkey")
    return J.fuzzy_contains_join(names, "full_name", dim, "n_name", "dname", "n_nationkey") \
        .select("poll_id", "full_name", "matched_code")


@query("reindex_align", views=["appointments"], sql="""
SELECT n.n_nationkey AS nation, COALESCE(x.n, 0) AS n_appts
FROM nation n LEFT JOIN (SELECT c.c_nationkey, COUNT(*) AS n FROM appointments a JOIN customer c
                         ON a.patient_id = c.c_custkey WHERE a.insurance = '1-URGENT' GROUP BY 1) x
ON n.n_nationkey = x.c_nationkey""")
def reindex_align(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("insurance") == "1-URGENT")
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    agg = a.join(c, a.patient_id == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation")) \
        .agg(F.count(F.lit(1)).alias("n_appts"))
    keys = read_table(spark, sf, "nation", ["n_nationkey"]).select(F.col("n_nationkey").alias("nation"))
    return J.align_to_keys(keys, agg, ["nation"], {"n_appts": 0})


_SECTOR_COLS = V.SECTORS


@query("full_outer_align", views=["sector_prices"], sql="""
WITH r AS (SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret
           FROM sector_prices)
SELECT date, """ + ", ".join(f"round(MAX(ret) FILTER (WHERE ticker = '{s}'), 6) AS {s.lower()}" for s in V.SECTORS) + """
FROM r GROUP BY date""")
def full_outer_align(spark, sf):
    s = V.sector_prices(spark, sf)
    r = s.select("ticker", "date", W.pct_change("close", "ticker", "date").alias("_ret"))
    # the series stay long; side-by-side is one conditional aggregate per date
    return r.groupBy("date").agg(*[r6(F.max(F.when(F.col("ticker") == t, F.col("_ret")))).alias(t.lower())
                                   for t in _SECTOR_COLS])


@query("series_ratio_join", views=["prices"], sql="""
WITH r AS (SELECT ticker, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM prices)
SELECT ticker, round(MAX(close) FILTER (WHERE rn = 1) / MAX(close) FILTER (WHERE rn = 2), 6) AS latest_over_prev
FROM r GROUP BY ticker HAVING COUNT(*) FILTER (WHERE rn = 2) > 0""")
def series_ratio_join(spark, sf):
    top = W.top_n_per_key(V.prices(spark, sf), ["ticker"], [F.col("date").desc()], 2, ["date"])
    g = top.groupBy("ticker").agg(F.max(F.when(F.col("_rank") == 1, F.col("close"))).alias("_l"),
                                  F.max(F.when(F.col("_rank") == 2, F.col("close"))).alias("_p"))
    return g.filter(F.col("_p").isNotNull()).select("ticker", r6(F.col("_l") / F.col("_p")).alias("latest_over_prev"))


_FL = "(SELECT *, CAST(arr_delay >= 15 AS INTEGER) AS delayed FROM flights WHERE cancelled = 0 AND diverted = 0)"


@query("lookup_fallback_chain", views=["flights", "odds"], sql=f"""
, fl AS {_FL},
cs AS (SELECT carrier, 1 - avg(delayed) AS ontime FROM fl GROUP BY carrier),
ap AS (SELECT origin AS airport, 1 - avg(delayed) AS ontime FROM fl GROUP BY origin),
rs AS (SELECT route, avg(delayed) AS delay_rate FROM fl GROUP BY route HAVING COUNT(*) >= 60),
req AS (SELECT DISTINCT 'S' || CAST(game_key % 100 AS VARCHAR) AS carrier, home_team AS origin, away_team AS dest FROM odds
        WHERE home_team <> away_team)
SELECT req.carrier, req.origin, req.dest,
       round(1 - COALESCE(cs.ontime, 0.8), 6) AS carrier_delay,
       round(1 - COALESCE(o.ontime, 0.8), 6) AS origin_delay,
       round(1 - COALESCE(d.ontime, 0.8), 6) AS dest_delay,
       round(COALESCE(rs.delay_rate, ((1 - COALESCE(o.ontime, 0.8)) + (1 - COALESCE(d.ontime, 0.8))) / 2), 6) AS route_delay
FROM req LEFT JOIN cs ON req.carrier = cs.carrier LEFT JOIN ap o ON req.origin = o.airport
LEFT JOIN ap d ON req.dest = d.airport LEFT JOIN rs ON rs.route = req.origin || '_' || req.dest""")
def lookup_fallback_chain(spark, sf):
    f = V.flights(spark, sf).filter((F.col("cancelled") == 0) & (F.col("diverted") == 0)) \
        .withColumn("delayed", (F.col("arr_delay") >= 15).cast("int"))
    cs = f.groupBy("carrier").agg((1 - F.avg("delayed")).alias("_c"))
    ap = f.groupBy(F.col("origin").alias("airport")).agg((1 - F.avg("delayed")).alias("_a"))
    rs = f.groupBy("route").agg(F.avg("delayed").alias("_r"), F.count(F.lit(1)).alias("_n")).filter("_n >= 60")
    o = V.odds(spark, sf).filter(F.col("home_team") != F.col("away_team"))
    req = o.select(F.concat(F.lit("S"), (F.col("game_key") % 100).cast("string")).alias("carrier"),
                   F.col("home_team").alias("origin"), F.col("away_team").alias("dest")).distinct()
    req = req.withColumn("route", F.concat_ws("_", "origin", "dest"))
    out = J.fallback_chain(req, [(cs, ["carrier"], "_c", "c_on"),
                                 (ap.withColumnRenamed("airport", "origin"), ["origin"], "_a", "o_on"),
                                 (ap.withColumnRenamed("airport", "dest"), ["dest"], "_a", "d_on"),
                                 (rs, ["route"], "_r", "r_rate")], F.lit(None))
    od = 1 - F.coalesce("o_on", F.lit(0.8))
    dd = 1 - F.coalesce("d_on", F.lit(0.8))
    return out.select("carrier", "origin", "dest", r6(1 - F.coalesce("c_on", F.lit(0.8))).alias("carrier_delay"),
                      r6(od).alias("origin_delay"), r6(dd).alias("dest_delay"),
                      r6(F.coalesce("r_rate", (od + dd) / 2)).alias("route_delay"))


@query("nine_table_star", sql="""
SELECT cr.r_name AS customer_region, sr.r_name AS supplier_region, p.p_type,
       round(SUM(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue, COUNT(DISTINCT o.o_orderkey) AS n_orders
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN region cr ON cn.n_regionkey = cr.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation sn ON s.s_nationkey = sn.n_nationkey
JOIN region sr ON sn.n_regionkey = sr.r_regionkey
GROUP BY 1, 2, 3""")
def nine_table_star(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_type"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    nr = F.broadcast(read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
                     .join(read_table(spark, sf, "region", ["r_regionkey", "r_name"]),
                           F.col("n_regionkey") == F.col("r_regionkey")))   # 25 rows
    cn = nr.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("customer_region"))
    sn = nr.select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("supplier_region"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(cn, "c_nationkey")
           .join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(sn, "s_nationkey"))
    return j.groupBy("customer_region", "supplier_region", "p_type").agg(
        r2(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue"),
        F.count_distinct("o_orderkey").alias("n_orders"))
