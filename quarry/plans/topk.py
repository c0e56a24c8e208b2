"""Sort / top-k queries (SURVEY section F) and set operations (section G).

A sort followed by ``limit`` plans as TakeOrderedAndProject: every task
keeps its own top k and only k rows per task reach the final merge, so no
global sort of the input happens. Every ordering has a unique tie-break.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.scalar import round_to
from quarry.plans import views as V
from quarry.plans.catalog import query


def r6(c):
    return round_to(c, 6)


@query("order_limit", views=["flights"], sql="""
SELECT carrier, COUNT(*) AS n FROM flights GROUP BY carrier ORDER BY n DESC, carrier LIMIT 10""")
def order_limit(spark, sf):
    f = V.flights(spark, sf).groupBy("carrier").agg(F.count(F.lit(1)).alias("n"))
    return f.orderBy(F.desc("n"), "carrier").limit(10)


@query("top_bottom_movers", views=["prices", "tickers"], sql="""
WITH w AS (SELECT * FROM prices WHERE date >= CAST((SELECT MAX(date) FROM prices) - INTERVAL 7 DAY AS DATE)),
m AS (SELECT ticker, arg_max(close, date) / arg_min(close, date) - 1 AS move FROM w GROUP BY ticker),
j AS (SELECT m.ticker, t.sector, t.name, m.move FROM m JOIN tickers t ON m.ticker = t.ticker),
top AS (SELECT 'top' AS side, * FROM j ORDER BY move DESC, ticker LIMIT 10),
bot AS (SELECT 'bottom' AS side, * FROM j ORDER BY move ASC, ticker LIMIT 10)
SELECT side, ticker, sector, name, round(move, 6) AS move FROM top
UNION ALL SELECT side, ticker, sector, name, round(move, 6) AS move FROM bot""")
def top_bottom_movers(spark, sf):
    p = V.prices(spark, sf)
    start = F.date_sub(p.agg(F.max("date")).scalar(), 7)
    m = (p.filter(F.col("date") >= start).groupBy("ticker")
          .agg((F.max_by("close", "date") / F.min_by("close", "date") - 1).alias("move")))
    j = m.join(V.tickers(spark, sf).select("ticker", "sector", "name"), "ticker")
    top = j.orderBy(F.desc("move"), "ticker").limit(10).withColumn("side", F.lit("top"))
    bot = j.orderBy(F.asc("move"), "ticker").limit(10).withColumn("side", F.lit("bottom"))
    return top.unionByName(bot).select("side", "ticker", "sector", "name", r6(F.col("move")).alias("move"))


@query("two_stage_topk", views=["scored_events"], sql="""
WITH c AS (SELECT * FROM scored_events ORDER BY abs(score - 0.5) DESC, id LIMIT 50)
SELECT id, date, round(score, 6) AS score FROM c ORDER BY date DESC, id DESC LIMIT 20""")
def two_stage_topk(spark, sf):
    s = V.scored_events(spark, sf)
    c = s.orderBy(F.desc(F.abs(F.col("score") - 0.5)), "id").limit(50)
    return c.orderBy(F.desc("date"), F.desc("id")).limit(20).select("id", "date", r6(F.col("score")).alias("score"))


@query("order_by_expr_nulls", views=["scored_docs"], sql="""
SELECT doc_id, round(CASE WHEN lang = 'en' THEN NULL ELSE prob - 0.5 END, 6) AS edge FROM scored_docs
ORDER BY COALESCE(abs(CASE WHEN lang = 'en' THEN NULL ELSE prob - 0.5 END), 0) DESC, doc_id LIMIT 10""")
def order_by_expr_nulls(spark, sf):
    s = V.scored_docs(spark, sf).withColumn("edge", F.when(F.col("lang") == "en", None)
                                            .otherwise(F.col("prob") - 0.5))
    return (s.orderBy(F.coalesce(F.abs("edge"), F.lit(0.0)).desc(), "doc_id").limit(10)
             .select("doc_id", r6(F.col("edge")).alias("edge")))


@query("filtered_topk", views=["scored_events"], sql="""
WITH f AS (SELECT * FROM scored_events WHERE score >= 0.6),
pick AS (SELECT * FROM f UNION ALL SELECT * FROM scored_events WHERE (SELECT COUNT(*) FROM f) = 0)
SELECT id, user_id, round(score, 6) AS score FROM pick ORDER BY score DESC, id LIMIT 20""")
def filtered_topk(spark, sf):
    s = V.scored_events(spark, sf)
    hits = s.filter(F.col("score") >= 0.6)
    n = hits.agg(F.count(F.lit(1))).scalar()
    # fall back to all rows only when nothing passes (no padding otherwise)
    pick = s.filter((F.col("score") >= 0.6) | (n == 0))
    return pick.orderBy(F.desc("score"), "id").limit(20).select("id", "user_id", r6(F.col("score")).alias("score"))


@query("multi_key_sort", views=["appointments"], sql="""
SELECT patient_id, appt_date, appt_id FROM appointments ORDER BY patient_id, appt_date, appt_id""")
def multi_key_sort(spark, sf):
    a = V.appointments(spark, sf)
    return a.select("patient_id", "appt_date", "appt_id").orderBy("patient_id", "appt_date", "appt_id")


@query("sort_records", views=["marketing"], sql="""
SELECT channel, round(SUM(revenue_attributed) / SUM(spend), 6) AS roas FROM marketing GROUP BY channel
ORDER BY roas DESC, channel""")
def sort_records(spark, sf):
    m = V.marketing(spark, sf).groupBy("channel").agg(r6(F.sum("revenue_attributed") / F.sum("spend")).alias("roas"))
    return m.orderBy(F.desc("roas"), "channel")


# ------------------------------------------------------------ set ops

@query("union_all", views=["prices", "sector_prices"], sql="""
SELECT ticker, date, round(close, 6) AS close FROM prices
UNION ALL SELECT ticker, date, round(close, 6) AS close FROM sector_prices""")
def union_all(spark, sf):
    a = V.prices(spark, sf).select("ticker", "date", "close")
    b = V.sector_prices(spark, sf).select("ticker", "date", "close")
    return a.unionByName(b).select("ticker", "date", r6(F.col("close")).alias("close"))


@query("distinct_first", views=["odds"], sql="""
SELECT game_key, fetch_date, arg_min(poll_id, (fetched_at, poll_id)) AS first_poll_id,
       arg_min(home_ml, (fetched_at, poll_id)) AS home_ml
FROM odds GROUP BY game_key, fetch_date""")
def distinct_first(spark, sf):
    o = V.odds(spark, sf)
    # first row per key in a given order = min_by on (order, tie-break): a
    # partial aggregate, never an order-dependent dropDuplicates
    g = o.groupBy("game_key", "fetch_date").agg(
        F.min_by(F.struct("poll_id", "home_ml"), F.struct("fetched_at", "poll_id")).alias("_f"))
    return g.select("game_key", "fetch_date", F.col("_f.poll_id").alias("first_poll_id"),
                    F.col("_f.home_ml").alias("home_ml"))


@query("key_intersection", views=["games"], sql="""
SELECT team_abbr FROM games WHERE is_home = 1 INTERSECT SELECT team_abbr FROM games WHERE is_home = 0""")
def key_intersection(spark, sf):
    g = V.games(spark, sf)
    return g.filter(F.col("is_home") == 1).select("team_abbr").intersect(
        g.filter(F.col("is_home") == 0).select("team_abbr"))


@query("distinct_values", views=["marketing"], sql="""
SELECT DISTINCT channel FROM marketing""")
def distinct_values(spark, sf):
    return V.marketing(spark, sf).select("channel").distinct()
