"""Projection / filter / predicate queries (SURVEY section B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.operators import windows as W
from quarry.operators.ordered import global_row_number
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.sources.tables import read_table


def r6(c):
    return S.round_to(c, 6)


@query("filter_conjunction", views=["flights"], sql="""
SELECT order_id, leg, carrier FROM flights
WHERE cancelled = 0 AND diverted = 0 AND flight_date >= DATE '1997-01-01' AND flight_date < DATE '1999-01-01'""")
def filter_conjunction(spark, sf):
    f = V.flights(spark, sf)
    cond = ((F.col("cancelled") == 0) & (F.col("diverted") == 0)
            & (F.col("flight_date") >= F.lit("1997-01-01").cast("date"))
            & (F.col("flight_date") < F.lit("1999-01-01").cast("date")))
    return f.filter(cond).select("order_id", "leg", "carrier")


@query("drop_null_rows", views=["prices"], sql="""
SELECT ticker, date FROM (
  SELECT ticker, date, ln(close / lag(close, 5) OVER (PARTITION BY ticker ORDER BY date)) AS r5,
         ln(close / lag(close, 20) OVER (PARTITION BY ticker ORDER BY date)) AS r20 FROM prices)
WHERE r5 IS NOT NULL AND r20 IS NOT NULL""")
def drop_null_rows(spark, sf):
    p = V.prices(spark, sf)
    p = p.withColumn("r5", W.log_return("close", "ticker", "date", 5)) \
         .withColumn("r20", W.log_return("close", "ticker", "date", 20))
    return p.na.drop(subset=["r5", "r20"]).select("ticker", "date")


MIN_HISTORY = 1540


@query("min_history_filter", views=["prices"], sql=f"""
SELECT ticker, date FROM prices WHERE ticker IN (SELECT ticker FROM prices GROUP BY ticker HAVING COUNT(*) >= {MIN_HISTORY})""")
def min_history_filter(spark, sf):
    p = V.prices(spark, sf)
    keep = p.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_HISTORY)
    return p.join(keep, "ticker", "left_semi").select("ticker", "date")


@query("sample_rows", views=["appointments"], sql="""
SELECT appt_id, patient_id FROM appointments
ORDER BY ((appt_id % 1000003) * 2654435761) % 4294967296, appt_id LIMIT 2000""")
def sample_rows(spark, sf):
    """min(2000, n) appointments without replacement, deterministic: the
    smallest values of a portable id hash (a sampling operator; the limit
    is the feature). Top-k per task, so no global sort."""
    from quarry.operators.metrics import split_hash
    a = V.appointments(spark, sf)
    return a.orderBy(split_hash("appt_id"), "appt_id").limit(2000).select("appt_id", "patient_id")


@query("in_list", views=["flights"], sql="""
SELECT carrier, COUNT(*) AS n_summer FROM flights
WHERE month IN (6, 7, 8) AND carrier NOT IN ('S1', 'S2', 'S3') GROUP BY carrier""")
def in_list(spark, sf):
    f = V.flights(spark, sf)
    f = f.filter(F.col("month").isin(6, 7, 8) & ~F.col("carrier").isin("S1", "S2", "S3"))
    return f.groupBy("carrier").agg(F.count(F.lit(1)).alias("n_summer"))


@query("text_match_filter", sql="""
SELECT lang, COUNT(*) FILTER (WHERE COALESCE(contains(lower(text), 'the'), false)) AS n_contains,
       COUNT(*) FILTER (WHERE regexp_matches(text, '[0-9]{4}')) AS n_regex, COUNT(*) AS n
FROM documents GROUP BY lang""")
def text_match_filter(spark, sf):
    d = read_table(spark, sf, "documents", ["lang", "text"])
    return d.groupBy("lang").agg(F.count_if(S.contains_ci("text", "the")).alias("n_contains"),
                                 F.count_if(F.col("text").rlike("[0-9]{4}")).alias("n_regex"),
                                 F.count(F.lit(1)).alias("n"))


@query("flag_columns", views=["flights"], sql="""
SELECT order_id, leg, CAST(arr_delay >= 15 AS INTEGER) AS delayed,
       CAST(crs_dep_time // 100 >= 18 AS INTEGER) AS is_evening, CAST(crs_dep_time // 100 <= 6 AS INTEGER) AS is_early,
       CAST(month IN (6, 7, 8) AS INTEGER) AS is_summer, CAST(month IN (12, 1, 2) AS INTEGER) AS is_winter
FROM flights""")
def flag_columns(spark, sf):
    f = V.flights(spark, sf)
    hour = S.hhmm_hour("crs_dep_time")
    return f.select("order_id", "leg", S.flag(F.col("arr_delay") >= 15).alias("delayed"),
                    S.flag(hour >= 18).alias("is_evening"), S.flag(hour <= 6).alias("is_early"),
                    S.flag(F.col("month").isin(6, 7, 8)).alias("is_summer"),
                    S.flag(F.col("month").isin(12, 1, 2)).alias("is_winter"))


@query("threshold_tiers", views=["scored_events"], sql="""
SELECT id, CASE WHEN score >= 0.5 THEN 'High' WHEN score >= 0.3 THEN 'Medium' ELSE 'Low' END AS risk_tier,
       CASE WHEN score >= 0.65 THEN 'strong buy' WHEN score >= 0.60 THEN 'buy'
            WHEN score <= 0.35 THEN 'strong sell' ELSE 'hold' END AS signal
FROM scored_events""")
def threshold_tiers(spark, sf):
    s = V.scored_events(spark, sf)
    risk = S.tiers("score", [(0.5, "High"), (0.3, "Medium")], "Low")
    sig = (F.when(F.col("score") >= 0.65, "strong buy").when(F.col("score") >= 0.60, "buy")
            .when(F.col("score") <= 0.35, "strong sell").otherwise("hold"))
    return s.select("id", risk.alias("risk_tier"), sig.alias("signal"))


@query("lenient_cast", sql="""
SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS raw_num,
       COALESCE(TRY_CAST(regexp_extract(p_brand, '#(.*)$', 1) AS DOUBLE), 0.0) AS brand_num,
       COALESCE(TRY_CAST(split_part(p_name, ' ', 1) AS DOUBLE), 0.0) AS name_num
FROM part""")
def lenient_cast(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_name"])
    return p.select("p_partkey", S.lenient_double("p_brand").alias("raw_num"),
                    S.lenient_double(F.regexp_extract("p_brand", "#(.*)$", 1), 0.0).alias("brand_num"),
                    S.lenient_double(F.split("p_name", " ")[0], 0.0).alias("name_num"))


@query("clean_strings", sql="""
SELECT c_custkey, upper(trim(CAST(c_name AS VARCHAR))) AS name_clean, trim(c_mktsegment) AS segment FROM customer""")
def clean_strings(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return c.select("c_custkey", S.clean_string("c_name", upper=True).alias("name_clean"),
                    S.clean_string("c_mktsegment").alias("segment"))


# Part type -> ordinal used as a model feature.
TYPE_ORDINAL = {"SMALL": 1, "MEDIUM": 2, "LARGE": 4}


@query("map_with_default", sql="""
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 4 ELSE 1 END AS size_ordinal,
       CASE p_type WHEN 'PROMO' THEN 'cosmetic' ELSE p_type END AS category
FROM part""")
def map_with_default(spark, sf):
    p = read_table(spark, sf, "part", ["p_partkey", "p_type"])
    return p.select("p_partkey", S.map_with_default("p_type", TYPE_ORDINAL, 1).alias("size_ordinal"),
                    S.map_with_default("p_type", {"PROMO": "cosmetic"}, keep_self=True).alias("category"))


@query("label_encode", views=["appointments"], sql="""
WITH d AS (SELECT DISTINCT COALESCE(channel, 'unknown') AS v FROM appointments),
c AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code FROM d)
SELECT a.appt_id, c.code AS channel_code FROM appointments a JOIN c ON COALESCE(a.channel, 'unknown') = c.v""")
def label_encode(spark, sf):
    a = V.appointments(spark, sf).withColumn("_v", F.coalesce("channel", F.lit("unknown")))
    d = a.select("_v").distinct()
    codes = global_row_number(d, ["_v"], "_rn").select("_v", (F.col("_rn") - 1).alias("channel_code"))
    return a.join(codes, "_v").select("appt_id", "channel_code")


@query("fill_defaults", views=["patients", "appointments"], sql="""
WITH last AS (SELECT patient_id, arg_max(insurance, (appt_date, appt_id)) AS last_insurance,
                     CAST(MAX(appt_date) - MIN(appt_date) AS INTEGER) AS span_days FROM appointments GROUP BY 1)
SELECT p.patient_id, COALESCE(l.last_insurance, '') AS last_insurance, COALESCE(l.span_days, 45) AS span_days
FROM patients p LEFT JOIN last l ON p.patient_id = l.patient_id""")
def fill_defaults(spark, sf):
    a = V.appointments(spark, sf)
    last = a.groupBy("patient_id").agg(F.max_by("insurance", F.struct("appt_date", "appt_id")).alias("last_insurance"),
                                       F.datediff(F.max("appt_date"), F.min("appt_date")).alias("span_days"))
    p = V.patients(spark, sf).select("patient_id").join(last, "patient_id", "left")
    return p.na.fill({"last_insurance": "", "span_days": 45})


@query("safe_divide", views=["marketing"], sql="""
SELECT month, channel, round(spend / NULLIF(new_patients, 0), 6) AS cac,
       round(COALESCE(revenue_attributed / NULLIF(spend, 0), 0), 6) AS roas FROM marketing""")
def safe_divide_q(spark, sf):
    m = V.marketing(spark, sf)
    return m.select("month", "channel", r6(S.safe_divide("spend", "new_patients")).alias("cac"),
                    r6(S.safe_divide("revenue_attributed", "spend", zero_as=0.0)).alias("roas"))


@query("clip_values", views=["prices"], sql="""
SELECT ticker, date, round(CASE WHEN r IS NULL THEN NULL ELSE least(greatest(r, -0.1), 0.1) END, 6) AS ret_clipped,
       round(least(volume, 500.0), 6) AS volume_capped
FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY date)) AS r FROM prices)""")
def clip_values(spark, sf):
    p = V.prices(spark, sf).withColumn("r", W.log_return("close", "ticker", "date", 1))
    return p.select("ticker", "date", r6(S.clip("r", -0.1, 0.1)).alias("ret_clipped"),
                    r6(S.clip("volume", upper=500.0)).alias("volume_capped"))


@query("prefix_columns", views=["games"], sql="""
SELECT game_id AS game_id, team_abbr AS home_team_abbr, pts AS home_pts, win AS home_win FROM games WHERE is_home = 1""")
def prefix_columns(spark, sf):
    g = V.games(spark, sf).filter(F.col("is_home") == 1).select("game_id", "team_abbr", "pts", "win")
    return g.withColumnsRenamed({c: f"home_{c}" for c in g.columns if c != "game_id"})


@query("derive_ratios", views=["games"], sql="""
WITH b AS (SELECT game_id, team_id, pts, opp_pts, fga - oreb + tov + 0.4 * fta AS poss, fga, fta FROM games)
SELECT game_id, team_id, round(poss, 6) AS poss, round(pts / NULLIF(poss, 0) * 100, 6) AS off_rtg,
       round(opp_pts / NULLIF(poss, 0) * 100, 6) AS def_rtg,
       round(pts / NULLIF(poss, 0) * 100 - opp_pts / NULLIF(poss, 0) * 100, 6) AS net_rtg,
       round(CASE WHEN 2 * (fga + 0.44 * fta) > 0 THEN pts / (2 * (fga + 0.44 * fta)) ELSE 0.0 END, 6) AS ts
FROM b""")
def derive_ratios(spark, sf):
    g = V.games(spark, sf)
    poss = F.col("fga") - F.col("oreb") + F.col("tov") + 0.4 * F.col("fta")
    g = g.withColumn("poss", poss)
    off = S.safe_divide("pts", "poss") * 100
    dfn = S.safe_divide(F.coalesce("opp_pts", F.lit(0.0)), F.col("poss")) * 100
    d = 2 * (F.col("fga") + 0.44 * F.col("fta"))
    return g.select("game_id", "team_id", r6(F.col("poss")).alias("poss"), r6(off).alias("off_rtg"),
                    r6(dfn).alias("def_rtg"), r6(off - dfn).alias("net_rtg"),
                    r6(F.when(d > 0, F.col("pts") / d).otherwise(0.0)).alias("ts"))


_DIFF = ["pts", "fga", "fta", "oreb", "tov"]


@query("difference_columns", views=["games"], sql="""
SELECT h.game_id, """ + ", ".join(f"h.{c} - a.{c} AS diff_{c}" for c in _DIFF) + """
FROM games h JOIN games a ON h.game_id = a.game_id AND h.is_home = 1 AND a.is_home = 0""")
def difference_columns(spark, sf):
    g = V.games(spark, sf)
    h = g.filter(F.col("is_home") == 1).select("game_id", *[F.col(c).alias(f"home_{c}") for c in _DIFF])
    a = g.filter(F.col("is_home") == 0).select("game_id", *[F.col(c).alias(f"away_{c}") for c in _DIFF])
    j = h.join(a, "game_id")
    # one select built from the column list
    return j.select("game_id", *[(F.col(f"home_{c}") - F.col(f"away_{c}")).alias(f"diff_{c}") for c in _DIFF])


@query("round_output", views=["payer"], sql="""
SELECT code, round(avg(payment), 2) AS avg_payment_half_up, round_even(avg(services) / 8, 2) AS svc_half_even
FROM payer GROUP BY code""")
def round_output(spark, sf):
    p = V.payer(spark, sf).groupBy("code").agg(F.avg("payment").alias("_a"), F.avg("services").alias("_s"))
    # bround = half-even (numpy .round); round_to = scaled half-up
    return p.select("code", S.round_to("_a", 2).alias("avg_payment_half_up"),
                    F.bround(F.col("_s") / 8, 2).alias("svc_half_even"))


FEATURES = ["close", "volume", "high", "dividend_yield", "low"]


@query("available_columns", views=["prices"], sql="""
SELECT ticker, date, round(close, 6) AS close, volume, round(high, 6) AS high, round(low, 6) AS low FROM prices""")
def available_columns(spark, sf):
    p = V.prices(spark, sf)
    present = [c for c in FEATURES if c in p.columns]   # 'dividend_yield' is reported missing
    return p.select("ticker", "date", *[r6(F.col(c)).alias(c) if c != "volume" else F.col(c) for c in present])


@query("select_with_default", views=["games"], sql="""
WITH h AS (SELECT game_id, pts AS home_pts, NULL::DOUBLE AS home_elo FROM games WHERE is_home = 1),
a AS (SELECT game_id, pts AS away_pts FROM games WHERE is_home = 0)
SELECT h.game_id, COALESCE(h.home_pts, 0.0) AS home_pts, COALESCE(a.away_pts, 0.0) AS away_pts,
       COALESCE(h.home_elo, 0.0) AS home_elo, COALESCE(h.home_pts - a.away_pts, 0.0) AS diff_pts
FROM h LEFT JOIN a ON h.game_id = a.game_id""")
def select_with_default(spark, sf):
    g = V.games(spark, sf)
    h = g.filter(F.col("is_home") == 1).select("game_id", F.col("pts").alias("home_pts"))
    a = g.filter(F.col("is_home") == 0).select("game_id", F.col("pts").alias("away_pts"))
    j = h.join(a, "game_id", "left")
    wanted = ["home_pts", "away_pts", "home_elo", "diff_pts"]

    def feat(c):
        if c in j.columns:
            return F.coalesce(F.col(c), F.lit(0.0)).alias(c)
        if c.startswith("diff_"):
            b = c[5:]
            return F.coalesce(F.col(f"home_{b}") - F.col(f"away_{b}"), F.lit(0.0)).alias(c)
        return F.lit(0.0).alias(c)   # missing feature -> 0.0
    return j.select("game_id", *[feat(c) for c in wanted])
