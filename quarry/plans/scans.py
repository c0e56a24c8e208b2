"""Source / sink / ingest queries (SURVEY section A).

Each round-trip query writes data that Spark derived from the given tables
to a folder under the shared checkpoint area, reads it back with an
explicit schema and returns a result that the oracle computes straight
from the source tables.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalar import round_to
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.session import cut_lineage, scratch_path
from quarry.sources import files as IO
from quarry.sources import contracts as CT
from quarry.sources import ingest as ING
from quarry.sources.tables import read_table


def r6(c):
    return round_to(c, 6)


def r2(c):
    return round_to(c, 2)


def _scratch(spark, sf, name):
    return scratch_path(spark, f"{name}_{os.path.basename(sf.rstrip('/'))}")


FLIGHT_CSV_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("leg", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("carrier", T.StringType()),
    T.StructField("origin", T.StringType()), T.StructField("dest", T.StringType()),
    T.StructField("dep_delay", T.DoubleType()), T.StructField("arr_delay", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
])


@query("scan_csv_years", views=["flights"], sql="""
SELECT year, carrier, COUNT(*) AS n, round(avg(dep_delay), 6) AS avg_dep_delay FROM flights GROUP BY 1, 2""")
def scan_csv_years(spark, sf):
    """One CSV folder per year (partitioned write), read back with a fixed
    schema, keeping only the needed columns (pruned at the reader)."""
    path = _scratch(spark, sf, "flights_csv")
    f = V.flights(spark, sf).select("order_id", "leg", "month", "carrier", "origin", "dest", "dep_delay",
                                    "arr_delay", "year")
    IO.write_csv(f, path, partition_by=["year"])
    # year comes back from the folder names; 3 of 9 columns are read
    back = spark.read.csv(path, schema=FLIGHT_CSV_SCHEMA, header=True).select("year", "carrier", "dep_delay")
    return back.groupBy("year", "carrier").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("dep_delay")).alias("avg_dep_delay"))


@query("scan_csv_table", views=["appointments"], sql="""
SELECT strftime(appt_date, '%Y-%m') AS month, COUNT(*) AS n, round(SUM(revenue), 2) AS revenue FROM appointments GROUP BY 1""")
def scan_csv_table(spark, sf):
    """Whole-table CSV with dates as text; parsed to DATE once at the scan."""
    path = _scratch(spark, sf, "appointments_csv")
    a = V.appointments(spark, sf).select("appt_id", "patient_id", F.date_format("appt_date", "yyyy-MM-dd").alias("appt_date"),
                                         "revenue")
    IO.write_csv(a, path)
    back = IO.read_csv(spark, path, "appt_id long, patient_id long, appt_date string, revenue double",
                       date_cols=["appt_date"])
    return back.groupBy(F.date_format("appt_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), r2(F.sum("revenue")).alias("revenue"))


@query("scan_sql_table", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_quantity FROM lineitem
WHERE l_suppkey = 7 ORDER BY l_shipdate, l_orderkey, l_linenumber""")
def scan_sql_table(spark, sf):
    """Projection + equality predicate + order: both reach the parquet
    reader (ReadSchema of 5 columns, PushedFilters EqualTo(l_suppkey,7))."""
    li = read_table(spark, sf, "lineitem")
    return (li.filter(F.col("l_suppkey") == 7)
              .select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"), "l_quantity")
              .orderBy("ship_date", "l_orderkey", "l_linenumber"))


REPORT_SCHEMA = T.StructType([
    T.StructField("kpis", T.StructType([T.StructField("n_appointments", T.LongType()),
                                        T.StructField("total_revenue", T.DoubleType()),
                                        T.StructField("noshow_pct", T.DoubleType())])),
    T.StructField("channels", T.ArrayType(T.StructType([T.StructField("channel", T.StringType()),
                                                        T.StructField("revenue", T.DoubleType())]))),
    T.StructField("by_insurance", T.MapType(T.StringType(), T.LongType())),
    T.StructField("source", T.StringType()),
])


def _report(spark, sf):
    a = V.appointments(spark, sf)
    kpis = a.agg(F.struct(F.count(F.lit(1)).alias("n_appointments"), r2(F.sum("revenue")).alias("total_revenue"),
                          round_to(F.avg("no_show") * 100, 4).alias("noshow_pct")).alias("kpis"))
    ch = a.groupBy("channel").agg(r2(F.sum("revenue")).alias("revenue"))
    # sections are one-row aggregates over small grouped results (one
    # entry per channel / insurance class), attached as scalar subqueries
    chans = ch.agg(F.array_sort(F.collect_list(F.struct("channel", "revenue"))))
    ins = a.groupBy("insurance").agg(F.count(F.lit(1)).alias("n"))
    imap = ins.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("insurance", "n")))))
    return kpis.select("kpis", chans.scalar().alias("channels"), imap.scalar().alias("by_insurance"),
                       F.lit("generated").alias("source"))


@query("bundle_report", views=["appointments"], sql="""
SELECT (SELECT COUNT(*) FROM appointments) AS n_appointments,
       (SELECT round(SUM(revenue), 2) FROM appointments) AS total_revenue,
       (SELECT COUNT(DISTINCT channel) FROM appointments) AS n_channels,
       (SELECT COUNT(DISTINCT insurance) FROM appointments) AS n_insurance, 'generated' AS source""")
def bundle_report(spark, sf):
    """KPIs, channel list and insurance map in one JSON document."""
    doc = _report(spark, sf).select(IO.bundle(kpis=F.col("kpis"), channels=F.col("channels"),
                                              by_insurance=F.col("by_insurance"), source=F.col("source")).alias("report"))
    parsed = doc.select(F.from_json("report", REPORT_SCHEMA).alias("r"))
    return parsed.select(F.col("r.kpis.n_appointments").alias("n_appointments"),
                         F.col("r.kpis.total_revenue").alias("total_revenue"),
                         F.size("r.channels").cast("long").alias("n_channels"),
                         F.size(F.map_keys("r.by_insurance")).cast("long").alias("n_insurance"),
                         F.col("r.source").alias("source"))


@query("sink_json_report", views=["appointments"], sql="""
SELECT channel, round(SUM(revenue), 2) AS revenue FROM appointments GROUP BY channel""")
def sink_json_report(spark, sf):
    """Write the nested report as JSON and read the channel section back."""
    path = _scratch(spark, sf, "report_json")
    r = _report(spark, sf)
    r.coalesce(1).write.mode("overwrite").json(path)
    back = IO.read_json(spark, path, REPORT_SCHEMA)
    return back.select(F.inline("channels"))


@query("scan_json_report", views=["appointments"], sql="""
SELECT insurance, COUNT(*) AS n FROM appointments GROUP BY insurance""")
def scan_json_report(spark, sf):
    """Read a whole (multi-line) JSON document with an explicit schema."""
    path = _scratch(spark, sf, "report_doc")
    doc = _report(spark, sf).select(IO.bundle(kpis=F.col("kpis"), channels=F.col("channels"),
                                              by_insurance=F.col("by_insurance"), source=F.col("source")))
    IO.write_report(spark, doc, path)
    back = IO.read_json(spark, path, REPORT_SCHEMA, multi_line=True)
    return back.select(F.explode("by_insurance").alias("insurance", "n"))


@query("scan_json_records", sql="""
SELECT p_partkey, p_type FROM part WHERE contains(lower(p_type), 'sma')""")
def scan_json_records(spark, sf):
    """API-style JSON records: the column holding the type is found by name,
    rows kept whose type contains 'sma'; fewer than 100 rows fails the job."""
    path = _scratch(spark, sf, "part_json")
    read_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"]).write.mode("overwrite").json(path)
    recs = IO.read_json(spark, path, "p_partkey long, p_name string, p_type string")
    type_col = next(c for c in recs.columns if "type" in c.lower())
    out = recs.filter(F.coalesce(F.lower(F.col(type_col)).contains("sma"), F.lit(False)))
    IO.require_rows(recs, 100, "part records")
    return out.select("p_partkey", F.col(type_col).alias("p_type"))


# Bookmakers walked first, in this order.
PREFERRED_BOOKS = ["view", "purchase", "click", "signup"]


def _payload(spark, sf):
    """Nested quotes built from the polls: one document per (game, day),
    bookmakers sorted by key, each with an h2h market of two outcomes
    (latest poll of that book)."""
    o = V.odds(spark, sf)
    q = o.groupBy("game_key", "fetch_date", "home_team", "away_team", "book").agg(
        F.max_by(F.struct("home_ml", "away_ml"), F.struct("fetched_at", "poll_id")).alias("_q"))
    outcomes = F.array(F.struct(F.col("home_team").alias("name"), F.col("_q.home_ml").alias("price")),
                       F.struct(F.col("away_team").alias("name"),
                                F.when(F.col("book") != "error", F.col("_q.away_ml")).alias("price")))
    bk = q.select("game_key", "fetch_date", "home_team", "away_team",
                  F.struct(F.col("book").alias("key"),
                           F.array(F.struct(F.lit("h2h").alias("key"), outcomes.alias("outcomes"))).alias("markets"))
                  .alias("bk"))
    g = bk.groupBy("game_key", "fetch_date", "home_team", "away_team").agg(
        F.array_sort(F.collect_list("bk")).alias("bookmakers"))   # at most one entry per bookmaker
    return g.select(F.concat_ws("-", F.col("game_key").cast("string"), F.col("fetch_date").cast("string")).alias("id"),
                    "home_team", "away_team", "bookmakers")


@query("flatten_nested_quotes", views=["odds"], sql="""
WITH q AS (SELECT game_key, fetch_date, home_team, away_team, book,
                  arg_max(home_ml, (fetched_at, poll_id)) AS hm, arg_max(away_ml, (fetched_at, poll_id)) AS am
           FROM odds GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *, COALESCE(list_position(['view', 'purchase', 'click', 'signup'], book), 5) AS pr,
             CASE WHEN book <> 'error' THEN am END AS am2 FROM q)
SELECT CAST(game_key AS VARCHAR) || '-' || CAST(fetch_date AS VARCHAR) AS id, home_team, away_team,
       arg_min(hm, (pr, book)) FILTER (WHERE hm IS NOT NULL) AS home_ml,
       arg_min(am2, (pr, book)) FILTER (WHERE am2 IS NOT NULL) AS away_ml
FROM r GROUP BY 1, 2, 3""")
def flatten_nested_quotes(spark, sf):
    return ING.flatten_quotes(_payload(spark, sf), PREFERRED_BOOKS)


@query("extract_html_table", sql="""
WITH u AS (SELECT page_id, regexp_extract(html, '<ul>(.*?)</ul>', 1) AS ul FROM pages),
i AS (SELECT page_id, regexp_extract_all(ul, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hs,
             regexp_extract_all(ul, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS ts FROM u),
e AS (SELECT page_id, CAST(gs - 1 AS INTEGER) AS pos, trim(hs[gs]) AS href, trim(ts[gs]) AS text
      FROM (SELECT *, generate_subscripts(hs, 1) AS gs FROM i))
SELECT page_id, arg_min(pos, pos) AS pos, arg_min(href, pos) AS href, text FROM e GROUP BY page_id, text""")
def extract_html_table(spark, sf):
    pages = read_table(spark, sf, "pages", ["page_id", "html"])
    return ING.html_list_items(pages, "page_id", "html")


@query("wide_to_long_prices", views=["prices"], sql="""
SELECT ticker, date, round(close, 6) AS close, volume FROM prices""")
def wide_to_long_prices(spark, sf):
    """Wide multi-ticker frame (one column per ticker and field) -> long
    rows -> fields as columns again."""
    p = V.prices(spark, sf)
    names = [r["ticker"] for r in V.tickers(spark, sf).select("ticker").orderBy("ticker").collect()]  # 25 brands
    cols = [F.max(F.when(F.col("ticker") == t, F.col(f))).alias(f"{t}|{f}") for t in names for f in ("close", "volume")]
    wide = p.groupBy("date").agg(*cols)
    long = ING.wide_to_long(wide, ["date"], [f"{t}|{f}" for t in names for f in ("close", "volume")])
    back = ING.long_to_fields(long.filter(F.col("value").isNotNull()), ["ticker", "date"], "field", "value",
                              ["close", "volume"])
    return back.select("ticker", "date", r6(F.col("close")).alias("close"), "volume")


@query("normalise_headers", views=["prices"], sql="""
SELECT ticker, date, round(close, 6) AS close,
       round(CASE WHEN volume > 50 THEN close * 0.99 ELSE close END, 6) AS adj_close, volume FROM prices""")
def normalise_headers(spark, sf):
    raw = V.prices(spark, sf).select(
        F.col("ticker").alias(" Ticker "), F.col("date").alias("Date"), F.col("close").alias("Close Price"),
        F.when(F.col("volume") > 50, F.col("close") * 0.99).alias("Adj Close"), F.col("volume").alias("VOLUME"))
    mapping = {"ticker": ["ticker"], "date": ["date"], "adj_close": ["adj"], "close": ["close"], "volume": ["volume"]}
    d = ING.normalise_headers(raw, mapping)
    return d.select("ticker", "date", r6(F.col("close")).alias("close"), r6(F.col("adj_close")).alias("adj_close"),
                    "volume")


@query("sink_csv_table", views=["payer"], sql="""
SELECT code, description, round(SUM(services), 2) AS total_services FROM payer GROUP BY 1, 2""")
def sink_csv_table(spark, sf):
    path = _scratch(spark, sf, "payer_csv")
    agg = V.payer(spark, sf).groupBy("code", "description").agg(r2(F.sum("services")).alias("total_services"))
    IO.write_csv(agg, path)
    return IO.read_csv(spark, path, "code string, description string, total_services double")


@query("sink_replace_table", views=["payer"], sql="""
SELECT state, COUNT(DISTINCT provider_id) AS n_providers FROM payer GROUP BY state""")
def sink_replace_table(spark, sf):
    """Create-or-replace a catalog table stored under the shared folder."""
    path = _scratch(spark, sf, "payer_states_table")
    agg = V.payer(spark, sf).groupBy("state").agg(F.count_distinct("provider_id").alias("n_providers"))
    name = "quarry_payer_states"
    agg.write.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


@query("insert_or_ignore", views=["games"], sql="""
SELECT game_id, team_id, pts FROM games""")
def insert_or_ignore(spark, sf):
    """Batch overlapping the target and itself repeated with other values:
    stored rows never change, and the first copy of a new key wins."""
    g = V.games(spark, sf).select("game_id", "team_id", "pts", "game_date")
    target = g.filter(F.col("game_date") < F.lit("1999-01-01").cast("date")).drop("game_date")
    batch = g.filter(F.col("game_date") >= F.lit("1998-07-01").cast("date")).drop("game_date")
    batch = batch.withColumn("_seq", F.lit(1)).unionByName(
        batch.withColumn("pts", F.col("pts") + 1000).withColumn("_seq", F.lit(2)))
    out = ING.insert_or_ignore(target, batch, ["game_id", "team_id"], ["_seq"])
    return out.select("game_id", "team_id", "pts")


@query("insert_or_replace", views=["prices"], sql="""
SELECT ticker, date, round(CASE WHEN date >= (SELECT MAX(date) FROM prices) - 30 THEN close * 1.01 ELSE close END, 6) AS close
FROM prices""")
def insert_or_replace(spark, sf):
    """Upsert into a table stored by month: the last 30 days come again with
    other prices, and only their months are read and written anew."""
    path = _scratch(spark, sf, "prices_by_month")
    p = cut_lineage(V.prices(spark, sf).select("ticker", "date", "close", F.date_format("date", "yyyy-MM").alias("month")))
    start = F.date_sub(p.agg(F.max("date")).scalar(), 30)
    target = p.withColumn("_seq", F.lit(1))
    batch = p.filter(F.col("date") >= start).withColumn("close", F.col("close") * 1.01).withColumn("_seq", F.lit(2))
    IO.write_parquet(target.repartition("month"), path, ["month"])
    ING.upsert_partitions(batch, path, ["ticker", "date"], "_seq", "month")
    return spark.read.schema(target.schema).parquet(path).select("ticker", "date", r6(F.col("close")).alias("close"))


@query("append_snapshot", views=["odds"], sql="""
SELECT fetch_date, COUNT(*) AS n_polls FROM odds GROUP BY fetch_date""")
def append_snapshot(spark, sf):
    """Two poll batches appended to a table partitioned by fetch date; the
    write never dedupes."""
    path = _scratch(spark, sf, "odds_snapshots")
    o = V.odds(spark, sf).withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))
    mid = F.lit("2024-01-15").cast("date")
    IO.write_parquet(o.filter(F.col("fetch_date") < mid), path, ["fetch_date"], mode="overwrite")
    IO.write_parquet(o.filter(F.col("fetch_date") >= mid), path, ["fetch_date"], mode="append")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("fetch_date").cast("date").alias("fetch_date")).agg(F.count(F.lit(1)).alias("n_polls"))


@query("skip_complete_keys", views=["games"], sql="""
WITH c AS (SELECT DISTINCT team_abbr, season FROM games),
done AS (SELECT team_abbr, season FROM games WHERE game_date < DATE '2000-07-01' GROUP BY 1, 2 HAVING COUNT(*) >= 70)
SELECT c.team_abbr, c.season FROM c WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.team_abbr = c.team_abbr AND d.season = c.season)""")
def skip_complete_keys(spark, sf):
    g = V.games(spark, sf)
    cand = g.select("team_abbr", "season").distinct()
    existing = g.filter(F.col("game_date") < F.lit("2000-07-01").cast("date"))
    return ING.skip_complete_keys(cand, existing, ["team_abbr", "season"], 70)


@query("table_schemas", views=["games", "prices"], sql="""
SELECT 'games' AS table_name, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE game_id IS NULL OR team_id IS NULL) AS null_keys,
       COUNT(*) - COUNT(DISTINCT (game_id, team_id)) AS duplicate_keys FROM games
UNION ALL
SELECT 'prices', COUNT(*), COUNT(*) FILTER (WHERE ticker IS NULL OR date IS NULL),
       COUNT(*) - COUNT(DISTINCT (ticker, date)) FROM prices""")
def table_schemas(spark, sf):
    """Declared-key checks: row count, null keys, duplicate keys."""
    def check(df, name, keys):
        null = F.count_if(F.greatest(*[F.col(k).isNull() for k in keys]))
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), null.alias("null_keys"),
                      (F.count(F.lit(1)) - F.count_distinct(*keys)).alias("duplicate_keys"))
    return check(V.games(spark, sf), "games", ["game_id", "team_id"]).unionByName(
        check(V.prices(spark, sf), "prices", ["ticker", "date"]))


_F = CT.Field
# Declared schemas of five tables; a dividend column is declared that prices do not have.
CONTRACTS = {
    "games": CT.Contract("games", {"game_id": _F("string", False), "team_id": _F("long", False), "game_date": _F("date", False), "pts": _F("double")},
                         ["game_id", "team_id"]),
    "prices": CT.Contract("prices", {"ticker": _F("string", False), "date": _F("date", False), "close": _F("double"), "volume": _F("double", False),
                                     "dividend": _F("double")}, ["ticker", "date"]),
    "odds": CT.Contract("odds", {"poll_id": _F("long", False), "game_key": _F("long", False), "fetch_date": _F("date", False), "home_ml": _F("double", False)},
                        ["game_key", "fetch_date"]),
    "payer": CT.Contract("payer", {"provider_id": _F("long", False), "code": _F("string", False), "services": _F("double")}, ["provider_id", "code"]),
    "appointments": CT.Contract("appointments", {"appt_id": _F("long", False), "patient_id": _F("long", False), "appt_date": _F("date", False),
                                                 "revenue": _F("double")}, ["appt_id"]),
}
# What the raw text of a column holds in its stead where a condition on the row is true (None: a null).
RAW_FAULTS = {("games", "pts"): ("pts % 41 = 0", "DNP"), ("prices", "close"): ("volume % 50 = 0", "n/a"), ("odds", "home_ml"): ("poll_id % 17 = 0", None),
              ("appointments", "appt_date"): ("appt_id % 29 = 0", "tomorrow")}


def _contract_sql():
    lines = []
    for t, c in CONTRACTS.items():
        for name, f in c.fields.items():
            missing = name == "dividend"
            lines.append(f"SELECT '{t}' AS table_name, '{name}' AS column_name, 'missing' AS rule, {int(missing)}::BIGINT AS n")
            fault, text = RAW_FAULTS.get((t, name), ("FALSE", ""))
            if not missing:
                lines.append(f"SELECT '{t}', '{name}', 'type', count(*) FILTER (WHERE {fault if text else 'FALSE'}) FROM {t}")
                if not f.nullable:
                    lines.append(f"SELECT '{t}', '{name}', 'null', count(*) FILTER (WHERE {name} IS NULL OR {'FALSE' if text else fault}) FROM {t}")
        keys = ", ".join(c.keys)
        lines.append(f"SELECT '{t}', '*', 'key', (count(*) - count(DISTINCT ({keys})))::BIGINT FROM {t} WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in c.keys))
    return " UNION ALL ".join(lines)


@query("table_contracts", views=["games", "prices", "odds", "payer", "appointments"], sql=_contract_sql())
def table_contracts(spark, sf):
    """Raw text of five tables, with bad cells put in by a rule, held against
    their declared types, nullability and keys: a row a column and rule."""
    out = None
    for t, c in CONTRACTS.items():
        d = getattr(V, t)(spark, sf)
        names = [x for x in c.fields if x in d.columns]
        raw = [F.when(F.expr(RAW_FAULTS[t, x][0]), F.lit(RAW_FAULTS[t, x][1])).otherwise(F.col(x).cast("string")).alias(x)
               if (t, x) in RAW_FAULTS else F.col(x).cast("string").alias(x) for x in names]
        v = CT.violations(cut_lineage(d.select(*raw)), c)
        out = v if out is None else out.unionByName(v)
    return out


@query("provenance_tag", views=["payer"], sql="""
SELECT code, COUNT(*) AS n, 'generated' AS source FROM payer GROUP BY code""")
def provenance_tag(spark, sf):
    return V.payer(spark, sf).groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("generated"))


@query("patch_nan_metric", views=["prices"], sql="""
WITH m AS (SELECT ticker, arg_max(close, date) / arg_min(close, date) AS ratio,
                  CASE WHEN MIN(volume) < 2 THEN NULL ELSE MAX(close) / MIN(close) - 1 END AS metric
           FROM prices GROUP BY ticker)
SELECT ticker, round(COALESCE(metric, ratio * 100 / 100 - 1), 6) AS metric FROM m""")
def patch_nan_metric(spark, sf):
    """A metric that is NaN/null is rebuilt from the last point of its
    curve (value / 100 - 1, curve in percent of start)."""
    p = V.prices(spark, sf)
    m = p.groupBy("ticker").agg((F.max_by("close", "date") / F.min_by("close", "date") * 100).alias("last_point"),
                                F.when(F.min("volume") < 2, F.lit(float("nan")))
                                 .otherwise(F.max("close") / F.min("close") - 1).alias("metric"))
    patched = F.when(F.isnan("metric") | F.col("metric").isNull(), F.col("last_point") / 100 - 1).otherwise(F.col("metric"))
    return m.select("ticker", r6(patched).alias("metric"))
