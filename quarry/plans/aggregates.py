"""Aggregation queries (SURVEY section D) over the derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalar import flag, hhmm_hour, map_with_default, month_label, round_to, safe_divide
from quarry.operators import aggregates as A
from quarry.plans import views as V
from quarry.session import cut_lineage
from quarry.operators.ordered import exact_percentiles
from quarry.plans.catalog import query


def r2(c):
    return round_to(c, 2)


def r6(c):
    return round_to(c, 6)


def _flights_clean(spark, sf):
    """Shared prefix: drop cancelled/diverted, delayed = arrival delay >= 15."""
    f = V.flights(spark, sf)
    f = f.filter((F.col("cancelled") == 0) & (F.col("diverted") == 0))
    return f.withColumn("delayed", flag(F.col("arr_delay") >= 15))


_FLIGHTS_CLEAN = "(SELECT *, CAST(arr_delay >= 15 AS INTEGER) AS delayed FROM flights WHERE cancelled = 0 AND diverted = 0)"


# ---------------------------------------------------------------- flights

@query("group_rate_stats", views=["flights"], sql=f"""
SELECT carrier, round(1 - avg(delayed), 6) AS ontime_rate, round(avg(dep_delay), 6) AS avg_dep_delay,
       COUNT(*) AS n
FROM {_FLIGHTS_CLEAN} GROUP BY carrier""")
def group_rate_stats(spark, sf):
    f = _flights_clean(spark, sf)
    s = A.group_rate_stats(f, ["carrier"], "delayed", score="dep_delay")
    return s.select("carrier", r6("ontime_rate").alias("ontime_rate"),
                    r6("avg_dep_delay").alias("avg_dep_delay"), "n")


@query("group_having", views=["flights"], sql=f"""
SELECT route, round(avg(delayed), 6) AS delay_rate, COUNT(*) AS n
FROM {_FLIGHTS_CLEAN} GROUP BY route HAVING COUNT(*) >= 60""")
def group_having(spark, sf):
    f = _flights_clean(spark, sf)
    g = A.group_having(f, ["route"], [F.avg("delayed").alias("delay_rate")], 60)
    return g.select("route", r6("delay_rate").alias("delay_rate"), "n")


@query("year_month_rate", views=["flights"], sql=f"""
SELECT year, month, round(avg(delayed), 6) AS delay_rate, COUNT(*) AS n
FROM {_FLIGHTS_CLEAN} GROUP BY year, month""")
def year_month_rate(spark, sf):
    f = _flights_clean(spark, sf)
    return f.groupBy("year", "month").agg(r6(F.avg("delayed")).alias("delay_rate"),
                                          F.count(F.lit(1)).alias("n"))


@query("mean_of_means", views=["flights"], sql=f"""
, ym AS (SELECT year, month, avg(delayed) AS rate FROM {_FLIGHTS_CLEAN} GROUP BY year, month)
SELECT 'month' AS period, CAST(month AS INTEGER) AS bucket, round(avg(rate), 6) AS mean_rate FROM ym GROUP BY month
UNION ALL
SELECT 'year', CAST(year AS INTEGER), round(avg(rate), 6) FROM ym GROUP BY year""")
def mean_of_means(spark, sf):
    f = _flights_clean(spark, sf)
    parts = [A.mean_of_means(f, ["year", "month"], [p], "delayed")
             .select(F.lit(p).alias("period"), F.col(p).cast("int").alias("bucket"), r6("mean_rate").alias("mean_rate"))
             for p in ("month", "year")]
    return parts[0].unionByName(parts[1])


@query("dow_hour_grid", views=["flights"], sql=f"""
SELECT day_of_week, CAST(crs_dep_time // 100 AS INTEGER) AS dep_hour,
       round(avg(delayed), 6) AS delay_rate, COUNT(*) AS n
FROM {_FLIGHTS_CLEAN} GROUP BY 1, 2""")
def dow_hour_grid(spark, sf):
    f = _flights_clean(spark, sf).withColumn("dep_hour", hhmm_hour("crs_dep_time"))
    return f.groupBy("day_of_week", "dep_hour").agg(r6(F.avg("delayed")).alias("delay_rate"),
                                                    F.count(F.lit(1)).alias("n"))


@query("histogram_bins", views=["flights"], sql=f"""
WITH c AS (SELECT carrier, 100.0 * (1 - avg(delayed)) AS ontime_pct FROM {_FLIGHTS_CLEAN} GROUP BY carrier)
SELECT CAST(least(floor(ontime_pct / (100.0 / 30)) + 1, 30) AS INTEGER) AS bin, COUNT(*) AS n
FROM c GROUP BY 1""")
def histogram_bins(spark, sf):
    f = _flights_clean(spark, sf)
    per = f.groupBy("carrier").agg((F.lit(100.0) * (1 - F.avg("delayed"))).alias("ontime_pct"))
    return A.histogram(per, "ontime_pct", 0.0, 100.0, 30)


@query("distribution_box", views=["flights"], sql=f"""
SELECT carrier,
       round(quantile_cont(dep_delay, 0.0), 6) AS q0, round(quantile_cont(dep_delay, 0.25), 6) AS q1,
       round(quantile_cont(dep_delay, 0.5), 6) AS q2, round(quantile_cont(dep_delay, 0.75), 6) AS q3,
       round(quantile_cont(dep_delay, 1.0), 6) AS q4
FROM {_FLIGHTS_CLEAN} GROUP BY carrier""")
def distribution_box(spark, sf):
    f = _flights_clean(spark, sf)
    q = A.percentiles(f, ["carrier"], "dep_delay", {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0})
    return q.select("carrier", *[r6(c).alias(c) for c in ["q0", "q1", "q2", "q3", "q4"]])


# ------------------------------------------------------------ payer rows

@query("top_procedures", views=["payer"], sql="""
SELECT code, description, round(SUM(services), 2) AS total_services, CAST(SUM(beneficiaries) AS BIGINT) AS total_benes,
       round(avg(payment), 2) AS avg_payment, round(avg(allowed), 2) AS avg_allowed,
       round(avg(submitted), 2) AS avg_charge, COUNT(DISTINCT provider_id) AS n_providers
FROM payer GROUP BY code, description
ORDER BY total_services DESC, code, description LIMIT 20""")
def top_procedures(spark, sf):
    p = V.payer(spark, sf)
    g = p.groupBy("code", "description").agg(
        r2(F.sum("services")).alias("total_services"), F.sum("beneficiaries").alias("total_benes"),
        r2(F.avg("payment")).alias("avg_payment"), r2(F.avg("allowed")).alias("avg_allowed"),
        r2(F.avg("submitted")).alias("avg_charge"), F.count_distinct("provider_id").alias("n_providers"))
    return g.orderBy(F.desc("total_services"), "code", "description").limit(20)


# Procedure code -> category (codes of the payer view).
PROC_CATEGORIES = {"ECONOMY": "general", "STANDARD": "general", "SMALL": "surgical",
                   "LARGE": "surgical", "PROMO": "cosmetic"}


@query("payment_benchmarks", views=["payer"], sql="""
SELECT code, MIN(description) AS description, round(avg(payment), 2) AS avg_payment,
       round(avg(allowed), 2) AS avg_allowed, round(avg(submitted), 2) AS avg_charge,
       round(SUM(services), 2) AS total_services,
       round(quantile_cont(payment, 0.25), 2) AS p25_payment, round(quantile_cont(payment, 0.75), 2) AS p75_payment,
       CASE code WHEN 'ECONOMY' THEN 'general' WHEN 'STANDARD' THEN 'general' WHEN 'SMALL' THEN 'surgical'
                 WHEN 'LARGE' THEN 'surgical' WHEN 'PROMO' THEN 'cosmetic' ELSE 'other' END AS category
FROM payer GROUP BY code""")
def payment_benchmarks(spark, sf):
    # one pass to (code, payment) with sums beside the counts; averages and percentiles both come from it
    c = cut_lineage(V.payer(spark, sf).groupBy("code", "payment").agg(
        F.min("description").alias("description"), F.count("payment").alias("n"), F.sum("allowed").alias("allowed"),
        F.count("allowed").alias("n_allowed"), F.sum("submitted").alias("submitted"),
        F.count("submitted").alias("n_submitted"), F.sum("services").alias("services")))
    g = c.groupBy("code").agg(
        F.min("description").alias("description"), r2(F.sum(F.col("payment") * F.col("n")) / F.sum("n")).alias("avg_payment"),
        r2(F.sum("allowed") / F.sum("n_allowed")).alias("avg_allowed"),
        r2(F.sum("submitted") / F.sum("n_submitted")).alias("avg_charge"), r2(F.sum("services")).alias("total_services"))
    q = exact_percentiles(c, ["code"], "payment", {"p25_payment": 0.25, "p75_payment": 0.75}, weight="n")
    return (g.join(q, "code")
             .withColumn("p25_payment", r2(F.col("p25_payment")))
             .withColumn("p75_payment", r2(F.col("p75_payment")))
             .withColumn("category", map_with_default("code", PROC_CATEGORIES, "other")))


@query("avg_by_code_top", views=["payer"], sql="""
SELECT code, description, round(avg(payment), 2) AS avg_payment
FROM payer GROUP BY code, description ORDER BY avg(payment) DESC, code, description LIMIT 10""")
def avg_by_code_top(spark, sf):
    p = V.payer(spark, sf)
    g = p.groupBy("code", "description").agg(F.avg("payment").alias("_a"))
    return (g.orderBy(F.desc("_a"), "code", "description").limit(10)
             .select("code", "description", r2(F.col("_a")).alias("avg_payment")))


FOCUS_STATE = "NATION_3"


@query("geo_variation", views=["payer"], sql=f"""
WITH s AS (
  SELECT state, COUNT(DISTINCT provider_id) AS n_providers, avg(payment) AS avg_payment,
         SUM(services) AS total_services FROM payer GROUP BY state),
nat AS (SELECT avg(payment) AS national FROM payer),
foc AS (SELECT avg(payment) AS focus_avg, COUNT(DISTINCT provider_id) AS focus_providers
        FROM payer WHERE state = '{FOCUS_STATE}')
SELECT s.state, s.n_providers, round(s.avg_payment, 2) AS avg_payment, round(s.total_services, 2) AS total_services,
       round(nat.national, 2) AS national_avg_payment,
       round((s.avg_payment / nat.national - 1) * 100, 4) AS pct_vs_national,
       round(COALESCE(foc.focus_avg, nat.national), 2) AS focus_avg_payment,
       foc.focus_providers AS focus_providers
FROM s, nat, foc""")
def geo_variation(spark, sf):
    p = V.payer(spark, sf)
    # one pass by state; the country and the focus state are read off its few rows
    s = cut_lineage(p.groupBy("state").agg(F.count_distinct("provider_id").alias("n_providers"), F.sum("payment").alias("_sum"),
                                           F.count("payment").alias("_n"), F.sum("services").alias("_svc"))
                     .withColumn("_avg", F.col("_sum") / F.col("_n")))
    national = s.agg(F.sum("_sum") / F.sum("_n")).scalar()
    focus = s.filter(F.col("state") == FOCUS_STATE)
    focus_avg = focus.agg(F.max("_avg")).scalar()
    focus_n = focus.agg(F.coalesce(F.max("n_providers"), F.lit(0))).scalar()
    return s.select("state", "n_providers", r2(F.col("_avg")).alias("avg_payment"),
                    r2(F.col("_svc")).alias("total_services"),
                    r2(national).alias("national_avg_payment"),
                    round_to((F.col("_avg") / national - 1) * 100, 4).alias("pct_vs_national"),
                    r2(F.coalesce(focus_avg, national)).alias("focus_avg_payment"),
                    focus_n.alias("focus_providers"))


@query("share_of_total", views=["payer"], sql="""
WITH c AS (
  SELECT CASE code WHEN 'ECONOMY' THEN 'general' WHEN 'STANDARD' THEN 'general' WHEN 'SMALL' THEN 'surgical'
                   WHEN 'LARGE' THEN 'surgical' WHEN 'PROMO' THEN 'cosmetic' ELSE 'other' END AS category,
         SUM(services) AS volume FROM payer GROUP BY 1)
SELECT category, round(volume, 2) AS volume, round(volume * 100.0 / (SELECT SUM(volume) FROM c), 4) AS share
FROM c""")
def share_of_total(spark, sf):
    p = V.payer(spark, sf).withColumn("category", map_with_default("code", PROC_CATEGORIES, "other"))
    agg = p.groupBy("category").agg(F.sum("services").alias("volume"))
    s = A.share_of_total(agg, "volume", "share", 100.0)
    return s.select("category", r2(F.col("volume")).alias("volume"), round_to("share", 4).alias("share"))


@query("two_level_distribution", views=["payer"], sql="""
WITH p AS (SELECT provider_id, SUM(services) AS t FROM payer GROUP BY provider_id)
SELECT round(quantile_cont(t, 0.1), 4) AS p10, round(quantile_cont(t, 0.25), 4) AS p25,
       round(quantile_cont(t, 0.5), 4) AS p50, round(quantile_cont(t, 0.75), 4) AS p75,
       round(quantile_cont(t, 0.9), 4) AS p90, round(avg(t), 4) AS mean
FROM p""")
def two_level_distribution(spark, sf):
    p = V.payer(spark, sf)
    qs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    d = A.two_level_distribution(p, "provider_id", "services", qs)
    return d.select(*[round_to(c, 4).alias(c) for c in list(qs) + ["mean"]])


@query("subset_benchmark", views=["payer"], sql=f"""
SELECT description, round(avg(payment), 2) AS avg_payment, round(SUM(services), 2) AS total_services
FROM payer WHERE state = '{FOCUS_STATE}' GROUP BY description
ORDER BY SUM(services) DESC, description LIMIT 15""")
def subset_benchmark(spark, sf):
    p = V.payer(spark, sf).filter(F.col("state") == FOCUS_STATE)
    g = p.groupBy("description").agg(F.avg("payment").alias("_a"), F.sum("services").alias("_s"))
    return (g.orderBy(F.desc("_s"), "description").limit(15)
             .select("description", r2(F.col("_a")).alias("avg_payment"), r2(F.col("_s")).alias("total_services")))


@query("conditional_mean", views=["payer"], sql="""
SELECT round(CASE WHEN COUNT(*) FILTER (WHERE code = 'PROMO') > 0
                  THEN avg(payment) FILTER (WHERE code IN ('SMALL', 'LARGE', 'MEDIUM'))
                  ELSE 790.0 END, 2) AS procedure_avg
FROM payer""")
def conditional_mean(spark, sf):
    p = V.payer(spark, sf)
    return p.agg(r2(F.when(F.count_if(F.col("code") == "PROMO") > 0,
                           F.avg(F.when(F.col("code").isin("SMALL", "LARGE", "MEDIUM"), F.col("payment"))))
                    .otherwise(F.lit(790.0))).alias("procedure_avg"))


@query("distinct_counts", views=["payer"], sql="""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT provider_id) AS n_providers, COUNT(DISTINCT state) AS n_states,
       COUNT(DISTINCT code) AS n_codes, COUNT(DISTINCT description) AS n_descriptions FROM payer""")
def distinct_counts(spark, sf):
    p = V.payer(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("provider_id").alias("n_providers"),
                 F.count_distinct("state").alias("n_states"), F.count_distinct("code").alias("n_codes"),
                 F.count_distinct("description").alias("n_descriptions"))


# ------------------------------------------------------------ games

@query("standings", views=["games"], sql="""
SELECT season, team_abbr, CAST(SUM(CASE WHEN wl = 'W' THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(SUM(CASE WHEN wl = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS losses,
       round(SUM(CASE WHEN wl = 'W' THEN 1 ELSE 0 END) * 1.0 / COUNT(*), 6) AS win_pct
FROM games WHERE wl IN ('W', 'L') GROUP BY season, team_abbr""")
def standings(spark, sf):
    g = V.games(spark, sf).filter(F.col("wl").isin("W", "L"))
    w = F.sum(F.when(F.col("wl") == "W", 1).otherwise(0))
    return g.groupBy("season", "team_abbr").agg(
        w.cast("long").alias("wins"), F.sum(F.when(F.col("wl") == "L", 1).otherwise(0)).cast("long").alias("losses"),
        r6(w / F.count(F.lit(1))).alias("win_pct"))


@query("conditional_avg_split", views=["games"], sql="""
SELECT season, team_abbr,
       round(COALESCE(avg(CASE WHEN is_home = 1 THEN win END), 0), 6) AS home_win_pct,
       round(COALESCE(avg(CASE WHEN is_home = 0 THEN win END), 0), 6) AS away_win_pct,
       round(COALESCE(avg(CASE WHEN is_home = 1 THEN pts END), 0), 6) AS home_pts,
       round(COALESCE(avg(CASE WHEN is_home = 0 THEN pts END), 0), 6) AS away_pts
FROM games GROUP BY season, team_abbr""")
def conditional_avg_split(spark, sf):
    g = V.games(spark, sf)

    def cavg(cond, v, name):
        return r6(F.coalesce(F.avg(F.when(cond, F.col(v))), F.lit(0.0))).alias(name)
    h, a = F.col("is_home") == 1, F.col("is_home") == 0
    return g.groupBy("season", "team_abbr").agg(cavg(h, "win", "home_win_pct"), cavg(a, "win", "away_win_pct"),
                                                cavg(h, "pts", "home_pts"), cavg(a, "pts", "away_pts"))


@query("season_trend", views=["games"], sql="""
SELECT season, round(avg(CASE WHEN is_home = 1 THEN win END), 6) AS home_win_rate,
       round(avg(pts), 6) AS avg_pts, COUNT(DISTINCT game_id) AS n_games
FROM games GROUP BY season""")
def season_trend(spark, sf):
    g = V.games(spark, sf)
    return g.groupBy("season").agg(r6(F.avg(F.when(F.col("is_home") == 1, F.col("win")))).alias("home_win_rate"),
                                   r6(F.avg("pts")).alias("avg_pts"),
                                   F.count_distinct("game_id").alias("n_games"))


@query("month_scoring", views=["games"], sql="""
SELECT substr(CAST(game_date AS VARCHAR), 1, 7) AS month, round(avg(pts), 6) AS avg_pts, COUNT(*) AS n
FROM games WHERE pts > 0 GROUP BY 1""")
def month_scoring(spark, sf):
    g = V.games(spark, sf).filter(F.col("pts") > 0)
    return g.groupBy(F.substring(F.col("game_date").cast("string"), 1, 7).alias("month")).agg(
        r6(F.avg("pts")).alias("avg_pts"), F.count(F.lit(1)).alias("n"))


@query("head_to_head", views=["games"], sql="""
SELECT season, team_abbr, opponent_abbr, CAST(SUM(win) AS BIGINT) AS wins, COUNT(*) AS games
FROM games WHERE is_home = 1 GROUP BY season, team_abbr, opponent_abbr HAVING COUNT(*) >= 2""")
def head_to_head(spark, sf):
    g = V.games(spark, sf).filter(F.col("is_home") == 1)
    return A.group_having(g, ["season", "team_abbr", "opponent_abbr"],
                          [F.sum("win").cast("long").alias("wins")], 2, count_name="games")


@query("group_size", views=["games"], sql="""
SELECT season, COUNT(*) AS n_rows FROM games GROUP BY season""")
def group_size(spark, sf):
    return V.games(spark, sf).groupBy("season").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------ marketing

@query("ratio_of_sums", views=["marketing"], sql="""
SELECT channel, round(SUM(spend), 2) AS total_spend, CAST(SUM(new_patients) AS BIGINT) AS total_patients,
       round(SUM(revenue_attributed), 2) AS total_revenue,
       round(SUM(revenue_attributed) / NULLIF(SUM(spend), 0), 6) AS roas,
       round(SUM(spend) / NULLIF(SUM(new_patients), 0), 6) AS actual_cac
FROM marketing GROUP BY channel""")
def ratio_of_sums(spark, sf):
    m = V.marketing(spark, sf)
    return m.groupBy("channel").agg(
        r2(F.sum("spend")).alias("total_spend"), F.sum("new_patients").alias("total_patients"),
        r2(F.sum("revenue_attributed")).alias("total_revenue"),
        r6(safe_divide(F.sum("revenue_attributed"), F.sum("spend"))).alias("roas"),
        r6(safe_divide(F.sum("spend"), F.sum("new_patients"))).alias("actual_cac"))


@query("blended_ratios", views=["marketing"], sql="""
SELECT round(SUM(spend), 2) AS total_spend, CAST(SUM(new_patients) AS BIGINT) AS total_patients,
       round(SUM(spend) / NULLIF(SUM(new_patients), 0), 6) AS blended_cac,
       round(SUM(revenue_attributed) / NULLIF(SUM(spend), 0), 6) AS blended_roas
FROM marketing""")
def blended_ratios(spark, sf):
    m = V.marketing(spark, sf)
    return m.agg(r2(F.sum("spend")).alias("total_spend"), F.sum("new_patients").alias("total_patients"),
                 r6(safe_divide(F.sum("spend"), F.sum("new_patients"))).alias("blended_cac"),
                 r6(safe_divide(F.sum("revenue_attributed"), F.sum("spend"))).alias("blended_roas"))


@query("argmax_row", views=["marketing"], sql="""
WITH c AS (SELECT channel, SUM(revenue_attributed) / SUM(spend) AS roas FROM marketing GROUP BY channel)
SELECT arg_max(channel, roas) AS best_channel, round(MAX(roas), 6) AS best_roas FROM c""")
def argmax_row(spark, sf):
    m = V.marketing(spark, sf)
    c = m.groupBy("channel").agg((F.sum("revenue_attributed") / F.sum("spend")).alias("roas"))
    return c.agg(F.max_by("channel", "roas").alias("best_channel"), r6(F.max("roas")).alias("best_roas"))


@query("best_worst_pick", views=["marketing"], sql="""
WITH c AS (SELECT channel, SUM(revenue_attributed) / SUM(spend) AS roas FROM marketing GROUP BY channel),
b AS (SELECT arg_max(channel, roas) AS best, MAX(roas) AS best_roas,
             arg_min(channel, roas) AS worst, MIN(roas) AS worst_roas FROM c)
SELECT best, worst, round(best_roas, 6) AS best_roas, round(worst_roas, 6) AS worst_roas,
       best || ' returns ' || printf('%.2f', best_roas) || 'x on spend; ' || worst || ' returns ' ||
       printf('%.2f', worst_roas) || 'x.' AS narrative
FROM b""")
def best_worst_pick(spark, sf):
    m = V.marketing(spark, sf)
    c = m.groupBy("channel").agg((F.sum("revenue_attributed") / F.sum("spend")).alias("roas"))
    b = c.agg(F.max_by("channel", "roas").alias("best"), F.max("roas").alias("_br"),
              F.min_by("channel", "roas").alias("worst"), F.min("roas").alias("_wr"))
    return b.select("best", "worst", r6(F.col("_br")).alias("best_roas"), r6(F.col("_wr")).alias("worst_roas"),
                    F.format_string("%s returns %.2fx on spend; %s returns %.2fx.",
                                    "best", "_br", "worst", "_wr").alias("narrative"))


# Benchmark CAC / 2-year LTV / 2-year retention per channel,
# and the default used for any other channel.
CHANNEL_BENCHMARKS = {
    "google_search": (120, 1800, 0.55),
    "doctor_referral": (40, 3200, 0.74),
    "patient_referral": (55, 2800, 0.68),
    "instagram": (180, 1100, 0.41),
    "walk_in": (20, 1400, 0.48),
}
DEFAULT_BENCHMARK = (100, 1500, 0.50)


@query("ltv_by_channel_cac", views=["appointments", "patients"], sql="""
WITH pr AS (SELECT patient_id, SUM(revenue) AS ltv FROM appointments WHERE no_show = 0 GROUP BY patient_id),
d AS (SELECT p.patient_id, p.channel, COALESCE(pr.ltv, 0) AS ltv FROM patients p LEFT JOIN pr USING (patient_id))
SELECT channel, COUNT(*) AS n_patients, round(avg(ltv), 2) AS avg_ltv,
       CASE channel WHEN 'google_search' THEN 120 WHEN 'doctor_referral' THEN 40 WHEN 'patient_referral' THEN 55
                    WHEN 'instagram' THEN 180 WHEN 'walk_in' THEN 20 ELSE 100 END AS cac,
       round(avg(ltv) / CASE channel WHEN 'google_search' THEN 120 WHEN 'doctor_referral' THEN 40
                    WHEN 'patient_referral' THEN 55 WHEN 'instagram' THEN 180 WHEN 'walk_in' THEN 20 ELSE 100 END, 4)
         AS ltv_cac_ratio
FROM d GROUP BY channel""")
def ltv_by_channel_cac(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    pr = a.groupBy("patient_id").agg(F.sum("revenue").alias("ltv"))
    d = V.patients(spark, sf).join(pr, "patient_id", "left").withColumn("ltv", F.coalesce("ltv", F.lit(0.0)))
    cac = map_with_default("channel", {k: v[0] for k, v in CHANNEL_BENCHMARKS.items()}, DEFAULT_BENCHMARK[0])
    g = d.groupBy("channel").agg(F.count(F.lit(1)).alias("n_patients"), F.avg("ltv").alias("_l"))
    return g.select("channel", "n_patients", r2(F.col("_l")).alias("avg_ltv"), cac.cast("int").alias("cac"),
                    round_to(F.col("_l") / cac, 4).alias("ltv_cac_ratio"))


# ------------------------------------------------------- clinic visits

@query("value_shares", views=["appointments"], sql="""
WITH c AS (SELECT channel, insurance, COUNT(*) AS n FROM appointments GROUP BY 1, 2)
SELECT channel, insurance, n, round(n * 1.0 / SUM(n) OVER (PARTITION BY channel), 6) AS share FROM c""")
def value_shares(spark, sf):
    s = A.value_shares(V.appointments(spark, sf), "channel", "insurance")
    return s.withColumn("share", r6(F.col("share")))


@query("pivot_two_way", views=["appointments"], sql="""
SELECT strftime(appt_date, '%Y-%m') AS month,
       round(COALESCE(SUM(revenue) FILTER (WHERE is_cosmetic = 0), 0), 2) AS medical,
       round(COALESCE(SUM(revenue) FILTER (WHERE is_cosmetic = 1), 0), 2) AS cosmetic,
       round(SUM(revenue), 2) AS total
FROM appointments WHERE no_show = 0 GROUP BY 1""")
def pivot_two_way(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0).withColumn("month", month_label("appt_date"))
    p = A.pivot_sum(a, "month", "is_cosmetic", "revenue", [0, 1], names=["medical", "cosmetic"])
    return p.select("month", r2(F.col("medical")).alias("medical"), r2(F.col("cosmetic")).alias("cosmetic"),
                    r2(F.col("medical") + F.col("cosmetic")).alias("total"))


@query("trimmed_series_mean", views=["appointments"], sql="""
WITH m AS (SELECT strftime(appt_date, '%Y-%m') AS month, SUM(revenue) AS total
           FROM appointments WHERE no_show = 0 GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY month) AS a, row_number() OVER (ORDER BY month DESC) AS b,
             COUNT(*) OVER () AS n FROM m)
SELECT round(CASE WHEN MAX(n) > 8 THEN avg(total) FILTER (WHERE a > 4 AND b > 4) ELSE avg(total) END, 2)
         AS trimmed_monthly_revenue,
       round(avg(total), 2) AS avg_monthly_revenue
FROM r""")
def trimmed_series_mean(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    m = a.groupBy(month_label("appt_date").alias("month")).agg(F.sum("revenue").alias("total"))
    # Months are calendar-bounded; the 4 first/last are found by two tiny
    # scalar subqueries instead of a global window.
    n = m.agg(F.count(F.lit(1))).scalar()
    lo = m.orderBy("month").limit(4).agg(F.max("month")).scalar()
    hi = m.orderBy(F.desc("month")).limit(4).agg(F.min("month")).scalar()
    inner = (F.col("month") > lo) & (F.col("month") < hi)
    return m.agg(r2(F.when(n > 8, F.avg(F.when(inner, F.col("total")))).otherwise(F.avg("total")))
                 .alias("trimmed_monthly_revenue"),
                 r2(F.avg("total")).alias("avg_monthly_revenue"))


@query("recency_kpis", views=["appointments"], sql="""
WITH att AS (SELECT * FROM appointments WHERE no_show = 0),
mx AS (SELECT MAX(appt_date) AS last_date FROM att)
SELECT (SELECT COUNT(DISTINCT patient_id) FROM att, mx WHERE appt_date >= last_date - INTERVAL 365 DAY) AS active_patients,
       (SELECT COUNT(*) FROM att, mx WHERE appt_date >= last_date - INTERVAL 30 DAY) AS visits_last_30d,
       (SELECT COUNT(*) FROM att, mx WHERE year(appt_date) = year(last_date)) AS visits_last_year,
       (SELECT round(avg(t), 2) FROM (SELECT SUM(revenue) AS t FROM att GROUP BY patient_id)) AS avg_ltv,
       (SELECT round(avg(no_show) * 100, 4) FROM appointments) AS noshow_pct,
       (SELECT round(SUM(revenue), 2) FROM att) AS total_revenue""")
def recency_kpis(spark, sf):
    appts = V.appointments(spark, sf)
    att = appts.filter(F.col("no_show") == 0)
    last = att.agg(F.max("appt_date")).scalar()
    k = att.agg(
        F.count_distinct(F.when(F.col("appt_date") >= F.date_sub(last, 365), F.col("patient_id"))).alias("active_patients"),
        F.count_if(F.col("appt_date") >= F.date_sub(last, 30)).alias("visits_last_30d"),
        F.count_if(F.year("appt_date") == F.year(last)).alias("visits_last_year"),
        r2(F.sum("revenue")).alias("total_revenue"))
    ltv = att.groupBy("patient_id").agg(F.sum("revenue").alias("t")).agg(F.avg("t")).scalar()
    ns = appts.agg(F.avg("no_show")).scalar()
    return k.select("active_patients", "visits_last_30d", "visits_last_year", r2(ltv).alias("avg_ltv"),
                    round_to(ns * 100, 4).alias("noshow_pct"), "total_revenue")


@query("rfm", views=["appointments", "patients"], sql="""
WITH att AS (SELECT * FROM appointments WHERE no_show = 0),
snap AS (SELECT MAX(appt_date) + 1 AS d FROM att),
per AS (SELECT patient_id, MAX(appt_date) AS last_visit, COUNT(*) AS frequency, SUM(revenue) AS monetary
        FROM att GROUP BY patient_id)
SELECT p.patient_id, CAST(date_diff('day', per.last_visit, (SELECT d FROM snap)) AS INTEGER) AS recency,
       COALESCE(per.frequency, 0) AS frequency, round(COALESCE(per.monetary, 0), 2) AS monetary,
       CAST(per.patient_id IS NULL AS INTEGER) AS never_visited
FROM patients p LEFT JOIN per ON p.patient_id = per.patient_id""")
def rfm(spark, sf):
    att = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    snap = F.date_add(att.agg(F.max("appt_date")).scalar(), 1)
    r = A.rfm(att, "patient_id", "appt_date", "revenue", snap)
    p = V.patients(spark, sf).select("patient_id").join(r, "patient_id", "left")
    return p.select("patient_id", "recency", F.coalesce("frequency", F.lit(0)).alias("frequency"),
                    r2(F.coalesce("monetary", F.lit(0.0))).alias("monetary"),
                    F.col("frequency").isNull().cast("int").alias("never_visited"))


def _patient_value(spark, sf):
    att = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    pr = att.groupBy("patient_id").agg(F.sum("revenue").alias("monetary"))
    return V.patients(spark, sf).join(pr, "patient_id", "left") \
        .withColumn("monetary", F.coalesce("monetary", F.lit(0.0)))


_PATIENT_VALUE = """pv AS (
  SELECT p.patient_id, p.channel, COALESCE(x.m, 0) AS monetary FROM patients p
  LEFT JOIN (SELECT patient_id, SUM(revenue) AS m FROM appointments WHERE no_show = 0 GROUP BY patient_id) x
  ON p.patient_id = x.patient_id)"""


@query("ltv_stats", views=["appointments", "patients"], sql=f"""
, {_PATIENT_VALUE}
SELECT channel, round(avg(monetary), 2) AS mean_ltv, round(quantile_cont(monetary, 0.5), 2) AS median_ltv,
       COUNT(*) AS n FROM pv GROUP BY channel""")
def ltv_stats(spark, sf):
    pv = _patient_value(spark, sf)
    g = pv.groupBy("channel").agg(r2(F.avg("monetary")).alias("mean_ltv"), F.count(F.lit(1)).alias("n"))
    med = A.percentiles(pv, ["channel"], "monetary", {"median_ltv": 0.5})
    return g.join(med, "channel").withColumn("median_ltv", r2(F.col("median_ltv")))


@query("top_share", views=["appointments", "patients"], sql=f"""
, {_PATIENT_VALUE},
r AS (SELECT monetary, row_number() OVER (ORDER BY monetary DESC) AS rk, COUNT(*) OVER () AS n,
             SUM(monetary) OVER () AS tot FROM pv)
SELECT round(SUM(monetary) FILTER (WHERE rk <= greatest(n // 100, 1)) / MAX(tot), 6) AS top_1pct,
       round(SUM(monetary) FILTER (WHERE rk <= greatest(n // 10, 1)) / MAX(tot), 6) AS top_10pct,
       round(SUM(monetary) FILTER (WHERE rk <= greatest(n // 5, 1)) / MAX(tot), 6) AS top_20pct
FROM r""")
def top_share(spark, sf):
    pv = _patient_value(spark, sf)
    s = A.top_share(pv, "monetary", {"top_1pct": 0.01, "top_10pct": 0.10, "top_20pct": 0.20})
    return s.select(*[r6(c).alias(c) for c in ["top_1pct", "top_10pct", "top_20pct"]])


@query("gini", views=["appointments", "patients"], sql=f"""
, {_PATIENT_VALUE},
r AS (SELECT abs(monetary) AS x, row_number() OVER (ORDER BY abs(monetary)) AS i FROM pv)
SELECT round(2.0 * SUM(i * x) / (COUNT(*) * SUM(x)) - (COUNT(*) + 1.0) / COUNT(*), 6) AS gini FROM r""")
def gini(spark, sf):
    return A.gini(_patient_value(spark, sf), "monetary").select(r6(F.col("gini")).alias("gini"))


@query("cohort_retention", views=["appointments"], sql="""
WITH f AS (SELECT patient_id, MIN(appt_date) AS first FROM appointments GROUP BY patient_id),
fc AS (SELECT patient_id, first, CAST(year(first) AS VARCHAR) || 'Q' || CAST(quarter(first) AS VARCHAR) AS cohort FROM f),
c AS (SELECT cohort, MIN(first) AS start, COUNT(*) AS cohort_size FROM fc GROUP BY cohort),
w AS (SELECT cohort, start, cohort_size, o AS offset,
             CAST(start + to_months(o - 1) AS DATE) AS lo, CAST(start + to_months(o + 1) AS DATE) AS hi
      FROM c, (SELECT unnest([6, 12, 18, 24]) AS o)),
h AS (SELECT w.cohort, w.offset, COUNT(DISTINCT a.patient_id) AS retained
      FROM appointments a JOIN fc ON a.patient_id = fc.patient_id JOIN w ON fc.cohort = w.cohort
      WHERE a.no_show = 0 AND a.appt_date >= w.lo AND a.appt_date <= w.hi GROUP BY 1, 2)
SELECT w.cohort, CAST(w.offset AS INTEGER) AS offset, w.cohort_size, COALESCE(h.retained, 0) AS retained,
       round(COALESCE(h.retained, 0) * 1.0 / w.cohort_size, 6) AS retention
FROM w LEFT JOIN h ON w.cohort = h.cohort AND w.offset = h.offset""")
def cohort_retention(spark, sf):
    # cohort = quarter of the first appointment (any status); retention counts attended visits
    a = V.appointments(spark, sf).withColumn("attended", 1 - F.col("no_show"))
    r = A.cohort_retention(a, "patient_id", "appt_date", [6, 12, 18, 24], 1, attended="attended")
    return r.select("cohort", "offset", "cohort_size", "retained", r6(F.col("retention")).alias("retention"))


@query("seasonal_index", views=["appointments"], sql="""
WITH m AS (SELECT date_trunc('month', appt_date) AS month, SUM(revenue) AS total
           FROM appointments WHERE no_show = 0 GROUP BY 1),
c AS (SELECT CAST(month(month) AS INTEGER) AS cal_month, avg(total) AS mm FROM m GROUP BY 1),
g AS (SELECT avg(mm) AS grand FROM c),
cal AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS cal_month)
SELECT cal.cal_month, round(COALESCE(c.mm / g.grand, 1.0), 6) AS seasonal_index
FROM cal LEFT JOIN c ON cal.cal_month = c.cal_month, g""")
def seasonal_index(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    m = a.groupBy(F.trunc("appt_date", "month").alias("month")).agg(F.sum("revenue").alias("total"))
    s = A.seasonal_index(m, "month", "total")
    return s.select("cal_month", r6(F.col("seasonal_index")).alias("seasonal_index"))


# Fixed values of the payer benchmark: weekly patients of a solo practice,
# weeks per month, and the practice multiple (the payer is ~25 % of it).
WEEKLY_PATIENTS, WEEKS_PER_MONTH, PRACTICE_MULTIPLE = 90, 4.3, 4


@query("benchmark_gap", views=["appointments", "payer"], sql="""
WITH m AS (SELECT date_trunc('month', appt_date) AS month, SUM(revenue) AS total
           FROM appointments WHERE no_show = 0 GROUP BY 1),
b AS (SELECT 90 * avg(payment) * 4.3 * 4 AS implied FROM payer)
SELECT round(avg(total), 2) AS clinic_avg_monthly_revenue, round(MAX(implied), 2) AS implied_monthly_revenue,
       round((avg(total) / MAX(implied) - 1) * 100, 4) AS clinic_vs_benchmark_pct
FROM m, b""")
def benchmark_gap(spark, sf):
    a = V.appointments(spark, sf).filter(F.col("no_show") == 0)
    m = a.groupBy(F.trunc("appt_date", "month").alias("month")).agg(F.sum("revenue").alias("total"))
    implied = V.payer(spark, sf).agg(F.lit(WEEKLY_PATIENTS) * F.avg("payment") * F.lit(WEEKS_PER_MONTH)
                                     * F.lit(PRACTICE_MULTIPLE)).scalar()
    return m.agg(r2(F.avg("total")).alias("clinic_avg_monthly_revenue"),
                 r2(implied).alias("implied_monthly_revenue"),
                 round_to((F.avg("total") / implied - 1) * 100, 4).alias("clinic_vs_benchmark_pct"))


# Fixed values of the no-show impact model: years in the data set, share of
# appointments targeted, recovery rate of a double reminder.
DATA_YEARS, TARGET_FRACTION, RECOVERY_RATE = 3, 0.20, 0.35


@query("business_impact", views=["appointments"], sql="""
WITH s AS (SELECT COUNT(*) AS n, avg(no_show) AS rate, SUM(revenue) AS rev FROM appointments)
SELECT round(n / 3.0, 4) AS annual_appts, round(n / 3.0 * rate, 4) AS annual_noshow,
       round(rev / greatest(n, 1), 2) AS avg_revenue_per_appt,
       round(n / 3.0 * rate * rev / greatest(n, 1), 2) AS annual_rev_at_risk,
       round(n / 3.0 * 0.2, 4) AS targeted_high_risk,
       round(n / 3.0 * 0.2 * rate * 2 * 0.35 * rev / greatest(n, 1), 2) AS recoverable_revenue
FROM s""")
def business_impact(spark, sf):
    a = V.appointments(spark, sf)
    s = a.agg(F.count(F.lit(1)).alias("n"), F.avg("no_show").alias("rate"), F.sum("revenue").alias("rev"))
    annual = F.col("n") / F.lit(float(DATA_YEARS))
    avg_rev = F.col("rev") / F.greatest(F.col("n"), F.lit(1))
    return s.select(round_to(annual, 4).alias("annual_appts"),
                    round_to(annual * F.col("rate"), 4).alias("annual_noshow"),
                    r2(avg_rev).alias("avg_revenue_per_appt"),
                    r2(annual * F.col("rate") * avg_rev).alias("annual_rev_at_risk"),
                    round_to(annual * TARGET_FRACTION, 4).alias("targeted_high_risk"),
                    r2(annual * TARGET_FRACTION * F.col("rate") * 2 * RECOVERY_RATE * avg_rev)
                    .alias("recoverable_revenue"))


@query("revenue_summary", views=["appointments"], sql="""
SELECT round(SUM(revenue) FILTER (WHERE no_show = 0), 2) AS total_revenue,
       round(SUM(revenue) FILTER (WHERE no_show = 0 AND is_cosmetic = 1) * 100.0
             / SUM(revenue) FILTER (WHERE no_show = 0), 4) AS cosmetic_pct,
       COUNT(*) AS n_appointments, COUNT(*) FILTER (WHERE no_show = 0) AS n_attended,
       round(avg(no_show) * 100, 4) AS noshow_pct,
       round(SUM(revenue) FILTER (WHERE no_show = 1), 2) AS lost_revenue,
       round(SUM(revenue) FILTER (WHERE no_show = 0)
             / COUNT(DISTINCT strftime(appt_date, '%Y-%m')) FILTER (WHERE no_show = 0), 2) AS mean_monthly_revenue,
       round(COUNT(*) * 1.0 / COUNT(DISTINCT strftime(appt_date, '%Y-%m')), 4) AS mean_monthly_appointments
FROM appointments""")
def revenue_summary(spark, sf):
    a = V.appointments(spark, sf)
    att = F.col("no_show") == 0
    # one row a month first: months are few, and the means over months need no distinct count
    m = a.groupBy(F.date_format("appt_date", "yyyy-MM").alias("month")).agg(
        F.sum(F.when(att, F.col("revenue"))).alias("paid"),
        F.sum(F.when(att & (F.col("is_cosmetic") == 1), F.col("revenue"))).alias("cosmetic"),
        F.sum(F.when(F.col("no_show") == 1, F.col("revenue"))).alias("lost"),
        F.count(F.lit(1)).alias("n"), F.count_if(att).alias("attended"), F.sum("no_show").alias("missed"))
    return m.agg(
        r2(F.sum("paid")).alias("total_revenue"),
        round_to(F.sum("cosmetic") * 100.0 / F.sum("paid"), 4).alias("cosmetic_pct"),
        F.sum("n").alias("n_appointments"), F.sum("attended").alias("n_attended"),
        round_to(F.sum("missed") / F.sum("n") * 100, 4).alias("noshow_pct"), r2(F.sum("lost")).alias("lost_revenue"),
        r2(F.sum("paid") / F.count_if(F.col("attended") > 0)).alias("mean_monthly_revenue"),
        round_to(F.sum("n") / F.count_if(F.col("month").isNotNull()), 4).alias("mean_monthly_appointments"))


# ------------------------------------------------ lambdas as expressions

@query("lambda_aggregates", views=["flights"], sql=f"""
, fl AS {_FLIGHTS_CLEAN},
g AS (SELECT origin, 1 - avg(delayed) AS ontime, quantile_cont(dep_delay, 0.9) AS p90_delay FROM fl GROUP BY origin)
SELECT origin, round(ontime, 6) AS ontime_rate, round(p90_delay, 6) AS p90_delay,
       round((ontime - avg(ontime) OVER ()) / NULLIF(stddev_samp(ontime) OVER (), 0), 6) AS ontime_z
FROM g""")
def lambda_aggregates(spark, sf):
    """The reference's aggregate lambdas (1 - mean, percentile, z-score) as
    built-in aggregate expressions; no UDAF."""
    f = _flights_clean(spark, sf)
    g = f.groupBy("origin").agg((1 - F.avg("delayed")).alias("ontime"))
    p = A.percentiles(f, ["origin"], "dep_delay", {"p90_delay": 0.9})
    g = g.join(p, "origin")
    mean, sd = g.agg(F.avg("ontime")).scalar(), g.agg(F.stddev_samp("ontime")).scalar()
    return g.select("origin", r6(F.col("ontime")).alias("ontime_rate"), r6(F.col("p90_delay")).alias("p90_delay"),
                    r6(safe_divide(F.col("ontime") - mean, sd)).alias("ontime_z"))


@query("row_lambdas", views=["games"], sql="""
SELECT game_id, team_id, round(fga - oreb + tov + 0.4 * fta, 6) AS poss,
       round(CASE WHEN 2 * (fga + 0.44 * fta) > 0 THEN pts / (2 * (fga + 0.44 * fta)) ELSE 0.0 END, 6) AS ts,
       CASE WHEN win = 1 THEN pts ELSE -pts END AS signed_pts, lower(replace(team_abbr, '_', ' ')) AS team_name
FROM games""")
def row_lambdas(spark, sf):
    """Row-wise apply / element map of the reference as column expressions."""
    g = V.games(spark, sf)
    d = 2 * (F.col("fga") + 0.44 * F.col("fta"))
    return g.select("game_id", "team_id", r6(F.col("fga") - F.col("oreb") + F.col("tov") + 0.4 * F.col("fta")).alias("poss"),
                    r6(F.when(d > 0, F.col("pts") / d).otherwise(0.0)).alias("ts"),
                    F.when(F.col("win") == 1, F.col("pts")).otherwise(-F.col("pts")).alias("signed_pts"),
                    F.lower(F.replace("team_abbr", F.lit("_"), F.lit(" "))).alias("team_name"))
