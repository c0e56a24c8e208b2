"""Reference-shaped tables derived from the stored TPC-H-like tables.

Each view exists twice: a Spark builder (DataFrame API, what runs at
scale) and an independent DuckDB common-table expression used only by the
SQL oracle. The mapping follows FIXTURES.md ("Mapping used by queries()").

Scale notes
-----------
* ``nation``/``region`` are fixed-size (25/5 rows) and broadcast
  explicitly. Every other dimension grows with the scale factor, so the
  join strategy is left to the planner and AQE, whose broadcast decision
  is a runtime size check.
* Money sums that feed comparisons are done in integer cents, which is
  exact and independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.sources.tables import read_table

SECTORS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _nations(spark, sf):
    return F.broadcast(read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"]))


def _cents(c):
    return F.round(F.col(c) * 100).cast("long")


def _net_units(price="l_extendedprice", discount="l_discount"):
    """price * (1 - discount) in exact 1e-4 units (cents x percent): sums of
    these are integers, so totals do not depend on summation order."""
    return _cents(price) * F.round((1 - F.col(discount)) * 100).cast("long")


NET_UNITS_SQL = ("CAST(round({p}l_extendedprice * 100) AS BIGINT) * "
                 "CAST(round((1 - {p}l_discount) * 100) AS BIGINT)")


# ---------------------------------------------------------------- flights

def flights(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                              "l_quantity", "l_discount", "l_tax", "l_returnflag",
                                              "l_shipdate"])
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    n = _nations(spark, sf)
    ns = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin"))
    nc = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest"))
    # Orders-sized side first (orders + customer nation), so lineitem is
    # shuffled once by order key and once by supplier key; the supplier side
    # is supplier + nation. Nation lookups are broadcast (25 rows).
    od = o.join(c, o.o_custkey == c.c_custkey).join(nc, "c_nationkey").select("o_orderkey", "o_orderdate", "dest")
    sd = s.join(ns, "s_nationkey").select("s_suppkey", "origin")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(sd, li.l_suppkey == sd.s_suppkey)
    fd = F.to_date("l_shipdate")
    delay = F.datediff(fd, F.to_date("o_orderdate")).cast("double")
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("leg"),
        fd.alias("flight_date"),
        F.year(fd).alias("year"),
        F.month(fd).alias("month"),
        (F.weekday(fd) + 1).alias("day_of_week"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("carrier"),
        "origin", "dest",
        F.concat_ws("_", "origin", "dest").alias("route"),
        ((F.col("l_partkey") % 24) * 100 + (F.col("l_linenumber") * 7) % 60).cast("int").alias("crs_dep_time"),
        delay.alias("dep_delay"),
        (delay + F.col("l_tax") * 100).alias("arr_delay"),
        (F.col("l_returnflag") == "R").cast("int").alias("cancelled"),
        (F.col("l_discount") >= 0.1).cast("int").alias("diverted"),
        (F.col("l_quantity") * 100).alias("distance"),
    )


FLIGHTS_SQL = """
flights AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS leg,
         CAST(l.l_shipdate AS DATE) AS flight_date,
         CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CAST(month(l.l_shipdate) AS INTEGER) AS month,
         CAST(isodow(l.l_shipdate) AS INTEGER) AS day_of_week,
         'S' || CAST(l.l_suppkey AS VARCHAR) AS carrier,
         ns.n_name AS origin, nc.n_name AS dest,
         ns.n_name || '_' || nc.n_name AS route,
         CAST((l.l_partkey % 24) * 100 + (l.l_linenumber * 7) % 60 AS INTEGER) AS crs_dep_time,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS dep_delay,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) + l.l_tax * 100 AS arr_delay,
         CAST(l.l_returnflag = 'R' AS INTEGER) AS cancelled,
         CAST(l.l_discount >= 0.1 AS INTEGER) AS diverted,
         l.l_quantity * 100 AS distance
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
)"""


# ------------------------------------------------------------ payer rows

def payer(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                              "l_extendedprice", "l_discount", "l_tax"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    n = _nations(spark, sf).select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"))
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(n, "s_nationkey"))
    return j.select(
        F.col("l_suppkey").alias("provider_id"), "state",
        F.col("p_type").alias("code"), F.col("p_brand").alias("description"),
        F.col("l_quantity").alias("services"),
        F.col("l_linenumber").alias("beneficiaries"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("submitted"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("allowed"),
        F.col("l_extendedprice").alias("payment"),
    )


PAYER_SQL = """
payer AS (
  SELECT l.l_suppkey AS provider_id, n.n_name AS state,
         p.p_type AS code, p.p_brand AS description,
         l.l_quantity AS services, l.l_linenumber AS beneficiaries,
         l.l_extendedprice * (1 + l.l_tax) AS submitted,
         l.l_extendedprice * (1 - l.l_discount) AS allowed,
         l.l_extendedprice AS payment
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""


# ---------------------------------------------------- clinic: appointments

def appointments(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                           "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    cosmetic = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return j.select(
        F.col("o_orderkey").alias("appt_id"),
        F.col("o_custkey").alias("patient_id"),
        F.to_date("o_orderdate").alias("appt_date"),
        F.col("c_mktsegment").alias("channel"),
        F.col("o_orderpriority").alias("insurance"),
        (F.col("o_orderstatus") == "F").cast("int").alias("no_show"),
        F.col("o_totalprice").alias("revenue"),
        F.when(cosmetic, "cosmetic").otherwise("medical").alias("category"),
        cosmetic.cast("int").alias("is_cosmetic"),
    )


APPOINTMENTS_SQL = """
appointments AS (
  SELECT o.o_orderkey AS appt_id, o.o_custkey AS patient_id,
         CAST(o.o_orderdate AS DATE) AS appt_date,
         c.c_mktsegment AS channel, o.o_orderpriority AS insurance,
         CAST(o.o_orderstatus = 'F' AS INTEGER) AS no_show,
         o.o_totalprice AS revenue,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'cosmetic' ELSE 'medical' END AS category,
         CAST(o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS is_cosmetic
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""


def patients(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"]) \
        .select(F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("channel"),
                F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))


PATIENTS_SQL = """
patients AS (
  SELECT c_custkey AS patient_id, c_mktsegment AS channel, c_nationkey AS nation, c_acctbal AS balance
  FROM customer
)"""


# ------------------------------------------------------------ marketing

def marketing(spark: SparkSession, sf: str) -> DataFrame:
    """(month, channel) spend / new patients / attributed revenue.

    Lineitem is pre-aggregated per order (partial aggregation on the scan)
    before the order join, so the big-big join carries one row per order.
    """
    li = (read_table(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
          .groupBy("l_orderkey")
          .agg(F.sum(_net_units()).alias("net")))
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(li, o.o_orderkey == li.l_orderkey, "left"))
    return (j.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"),
                      F.col("c_mktsegment").alias("channel"))
             .agg((F.sum(_cents("o_totalprice")) / 10000.0).alias("spend"),
                  F.count_distinct("o_custkey").alias("new_patients"),
                  F.coalesce(F.sum("net") / 10000.0, F.lit(0.0)).alias("revenue_attributed")))


MARKETING_SQL = """
marketing AS (
  SELECT strftime(o.o_orderdate, '%Y-%m') AS month, c.c_mktsegment AS channel,
         SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) / 10000.0 AS spend,
         COUNT(DISTINCT o.o_custkey) AS new_patients,
         COALESCE(SUM(li.net) / 10000.0, 0.0) AS revenue_attributed
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, SUM(""" + NET_UNITS_SQL.format(p="") + """) AS net
             FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
  GROUP BY 1, 2
)"""


# ------------------------------------------------------------ games

def games(spark: SparkSession, sf: str) -> DataFrame:
    """Two rows per game (one per team), as in a team game log.

    Teams are customer nations, leagues are regions. For each day and
    region the nations with orders that day are paired in key order
    (1st v 2nd, 3rd v 4th); the lower key is home. Points are the team's
    daily order total in whole thousands (exact integer cents, floored), so
    every sum and mean of points is independent of summation order.

    The table is bounded by (days x nations), not by the scale factor.
    """
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = _nations(spark, sf)
    daily = (o.join(c, o.o_custkey == c.c_custkey)
              .groupBy(F.to_date("o_orderdate").alias("game_date"), F.col("c_nationkey").alias("team_id"))
              .agg(F.floor(F.sum(_cents("o_totalprice")) / 100000.0).cast("double").alias("pts"),
                   F.count(F.lit(1)).alias("n_orders"),
                   F.sum((F.col("o_orderstatus") == "O").cast("long")).alias("oreb"),
                   F.sum((F.col("o_orderstatus") == "P").cast("long")).alias("tov")))
    daily = daily.join(n.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_abbr"),
                                F.col("n_regionkey").alias("league")), "team_id")
    w = Window.partitionBy("game_date", "league").orderBy("team_id")
    daily = daily.withColumn("rn", F.row_number().over(w)).withColumn("slot", F.expr("(rn - 1) div 2"))
    wg = Window.partitionBy("game_date", "league", "slot")
    daily = daily.withColumn("n_in_slot", F.count(F.lit(1)).over(wg))
    g = daily.filter(F.col("n_in_slot") == 2)
    opp = g.select("game_date", "league", "slot", F.col("team_id").alias("opponent_id"),
                   F.col("team_abbr").alias("opponent_abbr"), F.col("pts").alias("opp_pts"))
    g = g.join(opp, ["game_date", "league", "slot"]).filter(F.col("team_id") != F.col("opponent_id"))
    is_home = (F.col("rn") % 2 == 1)
    win = (F.col("pts") > F.col("opp_pts")) | ((F.col("pts") == F.col("opp_pts")) & is_home)
    return g.select(
        F.year("game_date").cast("string").alias("season"),
        "team_id", "team_abbr", "league",
        F.concat_ws("-", F.date_format("game_date", "yyyyMMdd"), F.col("league").cast("string"),
                    F.col("slot").cast("string")).alias("game_id"),
        "game_date",
        F.when(is_home, F.concat_ws(" vs. ", "team_abbr", "opponent_abbr"))
         .otherwise(F.concat_ws(" @ ", "team_abbr", "opponent_abbr")).alias("matchup"),
        is_home.cast("int").alias("is_home"),
        "opponent_id", "opponent_abbr",
        F.when(win, "W").otherwise("L").alias("wl"),
        win.cast("int").alias("win"),
        "pts", "opp_pts",
        (F.col("n_orders") * 8.0).alias("fga"),
        (F.col("n_orders") * 2.0).alias("fta"),
        F.col("oreb").cast("double").alias("oreb"),
        F.col("tov").cast("double").alias("tov"),
    )


GAMES_SQL = """
games_daily AS (
  SELECT CAST(o.o_orderdate AS DATE) AS game_date, c.c_nationkey AS team_id,
         CAST(floor(SUM(CAST(round(o.o_totalprice * 100) AS BIGINT)) / 100000.0) AS DOUBLE) AS pts,
         COUNT(*) AS n_orders,
         SUM(CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END) AS oreb,
         SUM(CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END) AS tov
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
),
games_ranked AS (
  SELECT d.*, n.n_name AS team_abbr, n.n_regionkey AS league,
         row_number() OVER (PARTITION BY d.game_date, n.n_regionkey ORDER BY d.team_id) AS rn
  FROM games_daily d JOIN nation n ON d.team_id = n.n_nationkey
),
games_slotted AS (
  SELECT *, (rn - 1) // 2 AS slot,
         COUNT(*) OVER (PARTITION BY game_date, league, (rn - 1) // 2) AS n_in_slot
  FROM games_ranked
),
games AS (
  SELECT CAST(year(a.game_date) AS VARCHAR) AS season, a.team_id, a.team_abbr, a.league,
         strftime(a.game_date, '%Y%m%d') || '-' || CAST(a.league AS VARCHAR) || '-' || CAST(a.slot AS VARCHAR) AS game_id,
         a.game_date,
         CASE WHEN a.rn % 2 = 1 THEN a.team_abbr || ' vs. ' || b.team_abbr ELSE a.team_abbr || ' @ ' || b.team_abbr END AS matchup,
         CAST(a.rn % 2 = 1 AS INTEGER) AS is_home,
         b.team_id AS opponent_id, b.team_abbr AS opponent_abbr,
         CASE WHEN a.pts > b.pts OR (a.pts = b.pts AND a.rn % 2 = 1) THEN 'W' ELSE 'L' END AS wl,
         CAST(a.pts > b.pts OR (a.pts = b.pts AND a.rn % 2 = 1) AS INTEGER) AS win,
         a.pts, b.pts AS opp_pts,
         CAST(a.n_orders * 8.0 AS DOUBLE) AS fga, CAST(a.n_orders * 2.0 AS DOUBLE) AS fta,
         CAST(a.oreb AS DOUBLE) AS oreb, CAST(a.tov AS DOUBLE) AS tov
  FROM games_slotted a
  JOIN games_slotted b ON a.game_date = b.game_date AND a.league = b.league AND a.slot = b.slot
                       AND a.team_id <> b.team_id
  WHERE a.n_in_slot = 2
)"""


# ------------------------------------------------------------ prices

def _bars(df: DataFrame, key: str) -> DataFrame:
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (df.groupBy(F.col(key).alias("ticker"), F.to_date("l_shipdate").alias("date"))
              .agg((F.sum(_cents("l_extendedprice")) / (F.sum("l_quantity") * 100.0)).alias("close"),
                   F.max(unit).alias("high"), F.min(unit).alias("low"),
                   F.sum("l_quantity").alias("volume"))
              .withColumn("open", (F.col("high") + F.col("low")) / 2)
              .withColumn("adj_close", F.col("close"))
              .select("ticker", "date", "open", "high", "low", "close", "adj_close", "volume"))


def _priced_lines(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    p = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_type"])
    return li.join(p, li.l_partkey == p.p_partkey)


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars per brand (the 'tickers'); bounded by days x brands."""
    return _bars(_priced_lines(spark, sf), "p_brand")


def sector_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars per part type (the 'sector funds')."""
    return _bars(_priced_lines(spark, sf), "p_type")


def market_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Daily bars over all lines (the benchmark index)."""
    li = read_table(spark, sf, "lineitem", ["l_quantity", "l_extendedprice", "l_shipdate"])
    return _bars(li.withColumn("_all", F.lit("MARKET")), "_all")


def tickers(spark: SparkSession, sf: str) -> DataFrame:
    """Ticker dimension: brand -> sector by brand number (fixed rule)."""
    p = read_table(spark, sf, "part", ["p_brand"]).distinct()
    num = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    sectors = F.array(*[F.lit(s) for s in SECTORS])
    return p.select(F.col("p_brand").alias("ticker"),
                    F.concat(F.lit("Company "), F.col("p_brand")).alias("name"),
                    F.element_at(sectors, (num % len(SECTORS)) + 1).alias("sector"),
                    F.lit(0).alias("is_etf"))


def _bars_sql(name: str, key: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT {key} AS ticker, CAST(l_shipdate AS DATE) AS date,
         (MAX(l_extendedprice / l_quantity) + MIN(l_extendedprice / l_quantity)) / 2 AS open,
         MAX(l_extendedprice / l_quantity) AS high, MIN(l_extendedprice / l_quantity) AS low,
         SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) / (SUM(l_quantity) * 100.0) AS close,
         SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) / (SUM(l_quantity) * 100.0) AS adj_close,
         SUM(l_quantity) AS volume
  FROM {src}
  GROUP BY 1, 2
)"""


PRICES_SQL = _bars_sql("prices", "p.p_brand", "lineitem l JOIN part p ON l.l_partkey = p.p_partkey")
SECTOR_PRICES_SQL = _bars_sql("sector_prices", "p.p_type", "lineitem l JOIN part p ON l.l_partkey = p.p_partkey")
MARKET_PRICES_SQL = _bars_sql("market_prices", "'MARKET'", "lineitem")
TICKERS_SQL = """
tickers AS (
  SELECT p_brand AS ticker, 'Company ' || p_brand AS name,
         list_extract(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'],
                      CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) % 6 + 1) AS sector,
         0 AS is_etf
  FROM (SELECT DISTINCT p_brand FROM part)
)"""


# ------------------------------------------------------------ scored rows

def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """(id, score, label): score = value / 500, label = purchase. Ties included."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(F.col("event_id").alias("id"), F.to_date("ts").alias("date"), "user_id",
                    (F.col("value") / 500.0).alias("score"),
                    (F.col("event_type") == "purchase").cast("int").alias("label"))


SCORED_EVENTS_SQL = """
scored_events AS (
  SELECT event_id AS id, CAST(ts AS DATE) AS date, user_id, value / 500.0 AS score,
         CAST(event_type = 'purchase' AS INTEGER) AS label
  FROM events
)"""


def scored_docs(spark: SparkSession, sf: str) -> DataFrame:
    """labels join documents: prob is a fixed function of doc_id and n_chars."""
    lab = read_table(spark, sf, "labels", ["doc_id", "quality", "toxic"])
    d = read_table(spark, sf, "documents", ["doc_id", "n_chars", "lang"])
    j = lab.join(d, "doc_id")
    return j.select("doc_id", "lang",
                    (((F.col("doc_id") * 7919 + F.col("n_chars")) % 997) / 997.0).alias("prob"),
                    F.col("quality").alias("label"))


SCORED_DOCS_SQL = """
scored_docs AS (
  SELECT l.doc_id, d.lang, ((l.doc_id * 7919 + d.n_chars) % 997) / 997.0 AS prob, l.quality AS label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""


# ---------------------------------------------- telecom-style customers

def subscribers(spark: SparkSession, sf: str) -> DataFrame:
    """customer + order history: tenure = whole 30-day months up to the last
    order date of the data set; churn = no order in its last 365 days.

    The as-of date is a scalar subquery (one partial max per partition),
    not a join.
    """
    o = read_table(spark, sf, "orders", ["o_custkey", "o_orderdate"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    asof = o.agg(F.max(F.to_date("o_orderdate"))).scalar()
    per = o.groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first_order"),
                                     F.max(F.to_date("o_orderdate")).alias("last_order"),
                                     F.count(F.lit(1)).alias("n_orders"))
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    tenure = F.floor(F.datediff(asof, F.col("first_order")) / 30).cast("int")
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("contract"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("monthly_charges"),
        F.coalesce(tenure, F.lit(0)).alias("tenure"),
        F.coalesce(F.col("n_orders"), F.lit(0)).alias("n_orders"),
        F.when(F.col("last_order").isNull() | (F.datediff(asof, F.col("last_order")) > 365), 1)
         .otherwise(0).alias("churn"),
    )


SUBSCRIBERS_SQL = """
sub_per AS (
  SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order,
         MAX(CAST(o_orderdate AS DATE)) AS last_order, COUNT(*) AS n_orders
  FROM orders GROUP BY o_custkey
),
subscribers AS (
  SELECT c.c_custkey AS customer_id, c.c_mktsegment AS contract, c.c_nationkey AS nation,
         c.c_acctbal AS monthly_charges,
         COALESCE(CAST(date_diff('day', p.first_order, (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)) // 30 AS INTEGER), 0) AS tenure,
         COALESCE(p.n_orders, 0) AS n_orders,
         CASE WHEN p.last_order IS NULL
                OR date_diff('day', p.last_order, (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)) > 365
              THEN 1 ELSE 0 END AS churn
  FROM customer c LEFT JOIN sub_per p ON c.c_custkey = p.o_custkey
)"""


# ---------------------------------------------- e-commerce star (orders)

def shop_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order of the star: revenue from its lines, delivery days
    (first shipment vs order date, absolute), review score, payment type,
    customer nation and region. Lines are aggregated per order before the
    order join (both sides scale; sort-merge join on the order key)."""
    li = (read_table(spark, sf, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount", "l_shipdate"])
          .groupBy("l_orderkey")
          .agg((F.sum(_net_units()) / 10000.0).alias("revenue"),
               F.count(F.lit(1)).alias("n_items"),
               F.min(F.to_date("l_shipdate")).alias("first_ship")))
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = _nations(spark, sf)
    r = F.broadcast(read_table(spark, sf, "region", ["r_regionkey", "r_name"]))
    j = (o.join(li, o.o_orderkey == li.l_orderkey)
          .join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    od = F.to_date("o_orderdate")
    return j.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("n_name").alias("state"), F.col("r_name").alias("region"),
        od.alias("order_date"), "revenue", "n_items",
        F.abs(F.datediff("first_ship", od)).alias("delivery_days"),
        (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("score"),
        F.col("o_orderpriority").alias("payment_type"),
    )


SHOP_ORDERS_SQL = """
shop_orders AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, n.n_name AS state, r.r_name AS region,
         CAST(o.o_orderdate AS DATE) AS order_date, li.revenue, li.n_items,
         CAST(abs(date_diff('day', CAST(o.o_orderdate AS DATE), li.first_ship)) AS INTEGER) AS delivery_days,
         CAST(1 + o.o_orderkey % 5 AS INTEGER) AS score,
         o.o_orderpriority AS payment_type
  FROM orders o
  JOIN (SELECT l_orderkey, SUM(""" + NET_UNITS_SQL.format(p="") + """) / 10000.0 AS revenue, COUNT(*) AS n_items,
               MIN(CAST(l_shipdate AS DATE)) AS first_ship
        FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


# ------------------------------------------------------------ odds polls

def odds(spark: SparkSession, sf: str) -> DataFrame:
    """Polled quotes: one row per poll (event). game = user, teams from the
    user key, American moneylines from the event value."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    hi = F.col("value") >= 250
    return e.select(
        F.col("event_id").alias("poll_id"), F.col("user_id").alias("game_key"),
        F.col("ts").alias("fetched_at"), F.to_date("ts").alias("fetch_date"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("home_team"),
        F.concat(F.lit("NATION_"), ((F.col("user_id") + 7) % 25).cast("string")).alias("away_team"),
        F.when(hi, F.col("value") - 100).otherwise(-(F.col("value") + 100)).alias("home_ml"),
        F.when(hi, -F.col("value")).otherwise(F.col("value") + 50).alias("away_ml"),
        F.col("event_type").alias("book"),
    )


ODDS_SQL = """
odds AS (
  SELECT event_id AS poll_id, user_id AS game_key, ts AS fetched_at, CAST(ts AS DATE) AS fetch_date,
         'NATION_' || CAST(user_id % 25 AS VARCHAR) AS home_team,
         'NATION_' || CAST((user_id + 7) % 25 AS VARCHAR) AS away_team,
         CASE WHEN value >= 250 THEN value - 100 ELSE -(value + 100) END AS home_ml,
         CASE WHEN value >= 250 THEN -value ELSE value + 50 END AS away_ml,
         event_type AS book
  FROM events
)"""
