"""Model queries (SURVEY section I): Spark ML fits, scoring, calibration,
importance, search and bundles.

What a fit returns depends on the fitting algorithm, so the registered
queries return what an oracle can say too: the rows and labels of each split,
names, and flags that hold only if the model did its work (every row scored
with a probability, AUC above a bound, nearest centre, order by score). The
operators in ``operators/models.py`` return the models' own numbers.

Splits use a portable hash (MD5), so that the oracle splits alike. Tree and
iteration counts are parameters of the operators; fits here stop early on a
validation part.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.functions.scalar import round_to
from quarry.operators import models as ML
from quarry.operators import tuning as TU
from quarry.operators.metrics import auc_exact
from quarry.operators.ordered import global_row_number, grouped_running
from quarry.operators.windows import group_mean_encode
from quarry.plans import views as V
from quarry.plans.catalog import query
from quarry.plans.learning import _RFM_SQL, _rfm
from quarry.session import cut_lineage, scratch_path

DELAY_FEATURES = ["month", "day_of_week", "dep_hour", "is_evening", "is_early_morning", "is_summer", "is_winter", "distance", "dist_bin",
                  "origin_rate", "dest_rate", "carrier_rate", "route_rate"]
# Split as sets of values; bounded by ML.MOST_CATEGORIES.
DELAY_CATEGORIES = ["month", "day_of_week", "dep_hour", "dist_bin"]
# Upper bounds of the distance bins (miles).
DISTANCE_BINS = (500, 1000, 1500, 2000)
# Carrier / airport / route keys grow with the data, so they enter the model
# as delay rates fitted on the train split (group mean encodings), never as
# tree categoricals.
ENCODED = {"carrier": "carrier_rate", "origin": "origin_rate", "dest": "dest_rate", "route": "route_rate"}


def portable_percent(*keys):
    """0 to 99 from an MD5 of the keys, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys])), 1, 8), 16, 10).cast("long") % 100


def _percent_sql(*keys):
    text = " || '-' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 100)"


def is_probability(c="prob"):
    return F.coalesce(F.col(c).between(0.0, 1.0), F.lit(False))


def _auc_at_least(scored, label, bound):
    """The flag alone: AUC of the scored rows is there and at least the bound."""
    return auc_exact(scored, "prob", label).select(F.coalesce(F.col("auc") >= bound, F.lit(False)).alias("auc_ok"))


def _flight_calendar(d):
    """The features that follow from month, hour and distance."""
    return d.withColumns({"is_evening": (F.col("dep_hour") >= 18).cast("double"), "is_early_morning": (F.col("dep_hour") <= 6).cast("double"),
                          "is_summer": F.col("month").isin(6, 7, 8).cast("double"), "is_winter": F.col("month").isin(12, 1, 2).cast("double"),
                          "dist_bin": sum((F.col("distance") > b).cast("double") for b in DISTANCE_BINS)})


def _flight_features(spark, sf):
    f = V.flights(spark, sf).filter((F.col("cancelled") == 0) & (F.col("diverted") == 0))
    hour = (F.col("crs_dep_time") / 100).cast("int")
    return _flight_calendar(f.select(
        "order_id", "leg", "carrier", "origin", "dest", "route", F.col("month").cast("double").alias("month"),
        F.col("day_of_week").cast("double").alias("day_of_week"), hour.cast("double").alias("dep_hour"), "distance",
        (F.col("arr_delay") >= 15).cast("int").alias("delayed"),
        (portable_percent("order_id", "leg") < 80).alias("_train"),
        (portable_percent("order_id", "leg") >= 72).alias("_valid")))


def _encoded(f):
    for key, out in ENCODED.items():
        f = group_mean_encode(f, key, "delayed", out, fit_on=F.col("_train"))
    return f


#: What the small fits of the queries that only need some model take.
SMALL_FIT = dict(patience=2, max_depth=4, step=0.1, min_instances=1)


def _delay_model(spark, sf, most_rounds=500, patience=50, max_depth=6, step=0.05, min_instances=500):
    # the feature table is read by four encoders, the encoded one by the fit
    # and the scorer: each is materialised once in the shared checkpoint
    # folder instead of re-running the joins for each reader. The encoders
    # join on keys of few values, so what they return is dealt evenly.
    f = ML.with_category_text(cut_lineage(ML.dealt(_encoded(cut_lineage(_flight_features(spark, sf))))), DELAY_CATEGORIES)
    # rows 72 to 79 of the training part decide when to stop
    m, _ = ML.patient_gbt(f.filter("_train"), DELAY_FEATURES, "delayed", "_valid", DELAY_CATEGORIES, most_rounds=most_rounds,
                          patience=patience, max_depth=max_depth, step=step, min_instances=min_instances)
    return m, f


_FLOWN = "flown AS (SELECT *, CAST(arr_delay >= 15 AS INTEGER) AS delayed FROM flights WHERE cancelled = 0 AND diverted = 0)"


@query("boosted_trees_delay", views=["flights"], sql=f"""
, {_FLOWN}
SELECT carrier, round(1 - avg(delayed), 6) AS ontime_rate, count(*) AS n_flights, TRUE AS scored, TRUE AS auc_ok FROM flown
WHERE {_percent_sql('order_id', 'leg')} >= 80 GROUP BY carrier""")
def boosted_trees_delay(spark, sf):
    """GBT on 13 flight features, 4 of them split as sets: up to 500 rounds of
    64 leaves, less if the 50 last were no better on the validation part; per
    carrier the hold-out part's on-time rate,
    whether every row has a probability, and whether the model ranks delays
    (AUC of the whole part)."""
    m, f = _delay_model(spark, sf)
    s = cut_lineage(ML.score(m, f.filter(~F.col("_train"))).select("carrier", "delayed", "prob"))
    per = s.groupBy("carrier").agg(round_to(1 - F.avg("delayed"), 6).alias("ontime_rate"), F.count(F.lit(1)).alias("n_flights"),
                                   F.min(is_probability()).alias("scored"))
    return per.withColumn("auc_ok", _auc_at_least(s, "delayed", 0.5).scalar())


@query("batch_score", views=["flights"], sql=f"""
, {_FLOWN}
SELECT order_id, leg, TRUE AS scored FROM flown""")
def batch_score(spark, sf):
    m, f = _delay_model(spark, sf, most_rounds=5, **SMALL_FIT)
    return ML.score(m, f).select("order_id", "leg", is_probability().alias("scored"))


@query("gain_importance", sql="SELECT unnest([" + ", ".join(f"'{x}'" for x in DELAY_FEATURES) + """]) AS feature,
       TRUE AS share_ok, TRUE AS total_ok""")
def gain_importance(spark, sf):
    m, _ = _delay_model(spark, sf, most_rounds=5, **SMALL_FIT)
    df = ML.gain_importance(spark, m)
    return df.select("feature", F.col("share").between(0.0, 1.0).alias("share_ok"),
                     (F.abs(df.agg(F.sum("share")).scalar() - 1.0) < 1e-9).alias("total_ok"))


_ASKED = """
asked AS (
  SELECT DISTINCT 'S' || CAST(game_key % 100 AS VARCHAR) AS carrier, home_team AS origin, away_team AS dest,
         CAST(month(fetched_at) AS DOUBLE) AS month, CAST(hour(fetched_at) AS DOUBLE) AS dep_hour,
         isodow(fetched_at) AS day_of_week
  FROM odds WHERE home_team <> away_team)"""


_FACTORS = {"origin": "Origin airport congestion", "dest": "Destination airport congestion", "carrier": "Airline reliability",
            "route": "Route history", "season": "Seasonal effect", "hour": "Time-of-day effect"}


@query("score_requests", views=["flights", "odds"], sql=f"""
, {_FLOWN}, {_ASKED},
seen AS (SELECT * FROM flown WHERE {_percent_sql('order_id', 'leg')} < 80),
base AS (SELECT avg(delayed) AS rate FROM seen),
o AS (SELECT origin, avg(delayed) AS rate FROM seen GROUP BY 1), d AS (SELECT dest, avg(delayed) AS rate FROM seen GROUP BY 1),
c AS (SELECT carrier, avg(delayed) AS rate FROM seen GROUP BY 1), t AS (SELECT route, avg(delayed) AS rate FROM seen GROUP BY 1)
SELECT a.carrier, a.origin, a.dest, a.month, a.dep_hour, a.day_of_week, TRUE AS scored, TRUE AS tier_ok,
       round(100 * COALESCE(o.rate, base.rate), 1) AS origin_points, round(100 * COALESCE(d.rate, base.rate), 1) AS dest_points,
       round(100 * COALESCE(c.rate, base.rate), 1) AS carrier_points, round(100 * COALESCE(t.rate, (COALESCE(o.rate, base.rate) + COALESCE(d.rate, base.rate)) / 2), 1) AS route_points,
       CASE WHEN month IN (12, 1, 2, 6, 7) THEN 3.0::DOUBLE ELSE -1.0::DOUBLE END AS season_points,
       CASE WHEN dep_hour >= 18 THEN 3.5::DOUBLE WHEN dep_hour <= 9 THEN -1.5::DOUBLE ELSE 0.0::DOUBLE END AS hour_points
FROM asked a CROSS JOIN base LEFT JOIN o ON a.origin = o.origin LEFT JOIN d ON a.dest = d.dest
LEFT JOIN c ON a.carrier = c.carrier LEFT JOIN t ON t.route = a.origin || '_' || a.dest""")
def score_requests(spark, sf):
    """Requests (distinct routes of the odds polls, origin != dest) scored
    through the same feature pipeline, with tier, advice and the effects of
    six factors in percent points; the distance is the route's mean."""
    m, f = _delay_model(spark, sf, most_rounds=5, **SMALL_FIT)
    o = V.odds(spark, sf).filter(F.col("home_team") != F.col("away_team"))
    req = o.select(F.concat(F.lit("S"), (F.col("game_key") % 100).cast("string")).alias("carrier"),
                   F.col("home_team").alias("origin"), F.col("away_team").alias("dest"),
                   F.month("fetched_at").cast("double").alias("month"),
                   (F.weekday("fetched_at") + 1).cast("double").alias("day_of_week"),
                   F.hour("fetched_at").cast("double").alias("dep_hour")).distinct()
    req = req.withColumn("route", F.concat_ws("_", "origin", "dest"))
    train = cut_lineage(f.filter("_train").select("carrier", "origin", "dest", "route", "delayed", "distance"))
    base = train.agg(F.avg("delayed").alias("rate"), F.avg("distance").alias("far")).first()
    for key, out in ENCODED.items():
        more = [F.avg("distance").alias("distance")] if key == "route" else []
        req = req.join(train.groupBy(key).agg(F.avg("delayed").alias(out), *more), key, "left")
        # a route without history counts as its airports do
        req = req.withColumn(out, F.coalesce(out, (F.col("origin_rate") + F.col("dest_rate")) / 2 if key == "route" else F.lit(base["rate"])))
    req = ML.with_category_text(_flight_calendar(req.na.fill({"distance": base["far"] or 0.0})), DELAY_CATEGORIES)
    effects = {_FACTORS[k]: 100 * F.col(f"{k}_rate") for k in ("origin", "dest", "carrier", "route")} \
        | {_FACTORS["season"]: ML.season_effect(F.col("month")), _FACTORS["hour"]: ML.hour_effect(F.col("dep_hour"))}
    s = ML.advise(ML.score(m, req), "prob", effects)
    tier = F.when(F.col("prob") >= 0.5, "High").when(F.col("prob") >= 0.3, "Medium").otherwise("Low")
    return s.select("carrier", "origin", "dest", "month", "dep_hour", F.col("day_of_week").cast("long").alias("day_of_week"),
                    is_probability().alias("scored"), ((F.col("tier") == tier) & (F.length("advice") > 0)).alias("tier_ok"),
                    *[F.col("factors")[name].alias(f"{k}_points") for k, name in _FACTORS.items()])


NOSHOW_FEATURES = ["is_cosmetic", "prior_noshows", "prior_appts", "prior_rate", "is_first", "weekday", "month", "quarter", "is_weekend"]


@query("boosted_trees_noshow", views=["appointments"], sql="""
, r AS (SELECT no_show, row_number() OVER (ORDER BY appt_date, appt_id) AS rk, count(*) OVER () AS n FROM appointments)
SELECT count(*) FILTER (WHERE rk <= floor(n * 0.8)) AS n_train, count(*) FILTER (WHERE rk > floor(n * 0.8)) AS n_test,
       CAST(sum(no_show) FILTER (WHERE rk > floor(n * 0.8)) AS BIGINT) AS n_noshow, TRUE AS scored, TRUE AS auc_ok FROM r""")
def boosted_trees_noshow(spark, sf):
    """No-show GBT of 200 rounds on what is known when an appointment is made
    (history, calendar, kind), first 80 % by date against the rest."""
    a = V.appointments(spark, sf).withColumn("_one", F.lit(1).cast("long"))
    # patient history via the grouped prefix scan (no per-patient window)
    a = grouped_running(a, ["patient_id"], ["appt_date", "appt_id"], {"prior_noshows": "no_show", "prior_appts": "_one"})
    n0, n1 = F.col("prior_noshows").cast("double"), F.col("prior_appts").cast("double")
    a = a.select("appt_id", "appt_date", "no_show", F.col("is_cosmetic").cast("double").alias("is_cosmetic"),
                 n0.alias("prior_noshows"), n1.alias("prior_appts"), F.when(n1 > 0, n0 / n1).otherwise(0.0).alias("prior_rate"),
                 (n1 == 0).cast("double").alias("is_first"), F.weekday("appt_date").cast("double").alias("weekday"),
                 F.month("appt_date").cast("double").alias("month"), F.quarter("appt_date").cast("double").alias("quarter"),
                 (F.weekday("appt_date") >= 5).cast("double").alias("is_weekend"))
    # first 80 % by (date, id) is train: distributed rank, not a global sort
    n = a.agg(F.count(F.lit(1))).scalar()
    a = cut_lineage(global_row_number(a, ["appt_date", "appt_id"], "_rk").withColumn("_train", F.col("_rk") <= F.floor(n * 0.8)))
    m = ML.fitted(ML.gbt_pipeline(NOSHOW_FEATURES, "no_show", max_iter=200, max_depth=5, step=0.05, min_instances=20), a.filter("_train"))
    s = ML.score(m, a.filter(~F.col("_train")))
    test = s.agg(F.count(F.lit(1)).alias("n_test"), F.sum("no_show").alias("n_noshow"), F.min(is_probability()).alias("scored"))
    # the label does not follow from the features in this fixture: chance level is what can be asked of the ranking
    return test.select(a.filter("_train").agg(F.count(F.lit(1))).scalar().alias("n_train"), "n_test", "n_noshow", "scored",
                       _auc_at_least(s, "no_show", 0.4).scalar().alias("auc_ok"))


GAME_FEATURES = ["h_pts", "h_win", "h_opp", "a_pts", "a_win", "a_opp", "d_pts", "d_win"]


def _game_form(spark, sf, games_back=10):
    """Each game with both sides' form over their games before it, home and
    away ones alike; no number of the game itself."""
    g = V.games(spark, sf).select("game_id", "season", "game_date", "team_id", "is_home", "win", "pts", "opp_pts")
    from quarry.operators.windows import blocked
    b = blocked(g, "team_id", "game_date", back=games_back)
    w = Window.partitionBy("team_id", "_blk").orderBy("_idx").rowsBetween(-games_back, -1)
    f = b.select("*", F.avg("pts").over(w).alias("f_pts"), F.avg("win").over(w).alias("f_win"),
                 F.avg("opp_pts").over(w).alias("f_opp")).filter("_own")
    side = lambda p, home: f.filter(F.col("is_home") == home).select("game_id", *[F.col(f"f_{c}").alias(f"{p}_{c}") for c in ("pts", "win", "opp")])
    home = f.filter(F.col("is_home") == 1).select("game_id", "season", "win")
    j = home.join(side("h", 1), "game_id").join(side("a", 0), "game_id").na.fill(0.0)
    return j.withColumns({"d_pts": F.col("h_pts") - F.col("a_pts"), "d_win": F.col("h_win") - F.col("a_win")})


@query("boosted_trees_games", views=["games"], sql="""
, h AS (SELECT season, win FROM games WHERE is_home = 1), l AS (SELECT max(season) AS s FROM h)
SELECT count(*) FILTER (WHERE season <> s) AS n_train, count(*) FILTER (WHERE season = s) AS n_test,
       CAST(sum(win) FILTER (WHERE season = s) AS BIGINT) AS n_wins, TRUE AS scored, TRUE AS auc_ok FROM h, l""")
def boosted_trees_games(spark, sf):
    """Game-winner GBT on both sides' earlier form, with sample weights
    (restart season 0.6), the last season held out."""
    g = _game_form(spark, sf).withColumn("weight", F.when(F.col("season") == "2000", 0.6).otherwise(1.0))
    g = cut_lineage(g)
    last = g.agg(F.max("season")).scalar()
    m = ML.fitted(ML.gbt_pipeline(GAME_FEATURES, "win", max_iter=10, max_depth=3, weight="weight"), g.filter(F.col("season") != last))
    s = ML.score(m, g.filter(F.col("season") == last))
    test = s.agg(F.count(F.lit(1)).alias("n_test"), F.sum("win").alias("n_wins"), F.min(is_probability()).alias("scored"))
    return test.select(g.filter(F.col("season") != last).agg(F.count(F.lit(1))).scalar().alias("n_train"), "n_test", "n_wins", "scored",
                       _auc_at_least(s, "win", 0.4).scalar().alias("auc_ok"))


def _segments(spark, sf):
    r = _rfm(spark, sf)
    cols = ["recency", "frequency", "monetary"]
    st = r.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    z = r.select("patient_id", *cols, *[((F.col(c) - st[f"m_{c}"]) / (st[f"s_{c}"] or 1.0)).alias(f"z_{c}") for c in cols])
    return ML.kmeans(cut_lineage(z), [f"z_{c}" for c in cols], k=4)


@query("kmeans_segments", views=["appointments"], sql=f"""
, {_RFM_SQL}
SELECT patient_id, TRUE AS in_range, TRUE AS nearest FROM rfm""")
def kmeans_segments(spark, sf):
    """Segments of the scaled recency, frequency and value, the best of 20
    restarts; whether each patient's segment is one of four and its mean the
    nearest of the four, as it is only where the steps have ended."""
    s = _segments(spark, sf)
    zs = [c for c in s.columns if c.startswith("z_")]
    means = [r.asDict() for r in s.groupBy("segment").agg(*[F.avg(c).alias(c) for c in zs]).collect()]  # four rows
    dist = {r["segment"]: sum((F.col(c) - r[c]) ** 2 for c in zs) for r in means}
    own = F.coalesce(*[F.when(F.col("segment") == k, d) for k, d in dist.items()])
    return s.select("patient_id", F.col("segment").between(0, 3).alias("in_range"),
                    (F.sqrt(own) <= F.sqrt(F.least(*dist.values())) + 1e-6 if len(dist) > 1 else F.lit(True)).alias("nearest"))


# Segment names in score order (best first).
SEGMENT_NAMES = ["Champions", "Loyal", "At Risk", "Lost"]


@query("name_clusters", views=["appointments"], sql=f"""
, {_RFM_SQL}
SELECT unnest(['Champions', 'Loyal', 'At Risk', 'Lost']) AS name, unnest([1, 2, 3, 4])::BIGINT AS place,
       (SELECT count(*) FROM rfm) AS n_patients, TRUE AS in_order""")
def name_clusters(spark, sf):
    """Name k-means segments: score = -rec/max + freq/max + mon/max of the
    cluster means, best score -> first name (4 rows: a tiny ranking)."""
    seg = _segments(spark, sf)
    c = seg.groupBy("segment").agg(*[F.avg(x).alias(x) for x in ["recency", "frequency", "monetary"]],
                                   F.count(F.lit(1)).alias("n"))
    c = cut_lineage(c)
    mx = c.agg(*[F.max(x).alias(x) for x in ["recency", "frequency", "monetary"]]).first()
    c = c.withColumn("score", -F.col("recency") / mx["recency"] + F.col("frequency") / mx["frequency"]
                     + F.col("monetary") / mx["monetary"])
    ranked = global_row_number(c, [("score", False), "segment"], "_r")
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    w = Window.orderBy("_r")  # four rows
    return ranked.select(F.element_at(names, F.col("_r").cast("int")).alias("name"), F.col("_r").alias("place"),
                         c.agg(F.sum("n")).scalar().alias("n_patients"),
                         F.coalesce(F.lag("score").over(w) >= F.col("score"), F.lit(True)).alias("in_order"))


CHURN_FEATURES = ["tenure", "monthly_charges", "n_orders", "orders_per_month", "spend_rate"]


def _churn_frame(spark, sf):
    s = V.subscribers(spark, sf)
    months = F.greatest(F.col("tenure"), F.lit(1))
    return s.select("customer_id", F.col("tenure").cast("double").alias("tenure"), "monthly_charges",
                    F.col("n_orders").cast("double").alias("n_orders"), (F.col("n_orders") / months).cast("double").alias("orders_per_month"),
                    (F.col("monthly_charges") / months).cast("double").alias("spend_rate"), "churn",
                    (portable_percent("customer_id") < 80).alias("_train"))


def _scaled(d, features, fit_on):
    """Features less their mean, over their deviation, as fitted on some rows."""
    fit = d.filter(fit_on)
    st = fit.agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first()
    return d.withColumns({c: (F.col(c) - (st[f"m_{c}"] or 0.0)) / (st[f"s_{c}"] or 1.0) for c in features})


_CHURN_SPLIT = f"""
SELECT count(*) FILTER (WHERE {_percent_sql('customer_id')} < 80) AS n_train,
       count(*) FILTER (WHERE {_percent_sql('customer_id')} >= 80) AS n_test,
       CAST(sum(churn) FILTER (WHERE {_percent_sql('customer_id')} >= 80) AS BIGINT) AS n_churn,
       TRUE AS scored, TRUE AS auc_ok, TRUE AS accuracy_ok"""


def _churn_report(d, s, bound):
    """Counts of the split; the ranking reaches the bound and the accuracy is
    that of the larger class at least (to two standard errors)."""
    right = F.avg(((F.col("prob") >= 0.5).cast("int") == F.col("churn")).cast("double"))
    rate = F.avg(F.col("churn").cast("double"))
    test = s.agg(F.count(F.lit(1)).alias("n_test"), F.sum("churn").alias("n_churn"), F.min(is_probability()).alias("scored"),
                 (right >= F.greatest(rate, 1 - rate) - 1 / F.sqrt(F.count(F.lit(1)))).alias("accuracy_ok"))
    return test.select(d.filter("_train").agg(F.count(F.lit(1))).scalar().alias("n_train"), "n_test", "n_churn", "scored",
                       _auc_at_least(s, "churn", bound).scalar().alias("auc_ok"), "accuracy_ok")


@query("logistic_churn", views=["subscribers"], sql=_CHURN_SPLIT + """, 5::BIGINT AS n_coefficients FROM subscribers""")
def logistic_churn(spark, sf):
    """L2 logistic regression on five scaled features."""
    d = cut_lineage(_scaled(_churn_frame(spark, sf), CHURN_FEATURES, F.col("_train")))
    n = d.filter("_train").count()
    m = ML.logistic_pipeline(CHURN_FEATURES, "churn", c_inverse_reg=1.0, n=n).fit(d.filter("_train"))
    s = ML.score(m, d.filter(~F.col("_train")))
    used = sum(abs(v) > 0 for v in m.stages[-1].coefficients.toArray().tolist())
    return _churn_report(d, s, 0.6).withColumn("n_coefficients", F.lit(used).cast("long"))


@query("forest_churn", views=["subscribers"], sql=_CHURN_SPLIT + " FROM subscribers")
def forest_churn(spark, sf):
    d = cut_lineage(_churn_frame(spark, sf))
    m = ML.fitted(ML.forest_pipeline(CHURN_FEATURES, "churn", trees=20, depth=5), d.filter("_train"))
    return _churn_report(d, ML.score(m, d.filter(~F.col("_train"))), 0.6)


#: Trials and folds of the registered search, and bounds that keep its fits small; all are arguments of the operator.
SEARCH_TRIALS, SEARCH_FOLDS = 6, 5
SEARCH_SPACE = TU.GBT_SPACE | {"max_iter": TU.Dimension(4, 12, whole=True), "max_depth": TU.Dimension(2, 5, whole=True),
                               "step": TU.Dimension(0.05, 0.3, log=True)}


@query("param_search", views=["subscribers"], sql=f"""
, r AS (SELECT *, (row_number() OVER (ORDER BY tenure DESC, customer_id) - 1) * {SEARCH_FOLDS + 1} // count(*) OVER () AS block FROM subscribers)
SELECT t.trial, f.fold, count(*) FILTER (WHERE block < f.fold) AS n_train, count(*) FILTER (WHERE block = f.fold) AS n_test,
       TRUE AS in_space, TRUE AS learned
FROM r, (SELECT unnest(range(1, {SEARCH_TRIALS + 1})) AS trial) t, (SELECT unnest(range(1, {SEARCH_FOLDS + 1})) AS fold) f GROUP BY 1, 2""")
def param_search(spark, sf):
    """A Parzen search over the five parameters of boosted trees, each trial
    valued by its mean AUC over five expanding folds in the order of first
    orders. Returned: sizes of each fit, whether the trial's five parameters
    lie in the space, and whether the best trial ranks churn (a mean AUC of
    0.6; a constant model has 0.5)."""
    d = V.subscribers(spark, sf)
    n = d.agg(F.count(F.lit(1))).scalar()
    d = _churn_frame(spark, sf).join(global_row_number(d.select("customer_id", "tenure"), [("tenure", False), "customer_id"], "_rk")
                                     .select("customer_id", "_rk"), "customer_id")
    d = cut_lineage(d.withColumn("_block", F.floor((F.col("_rk") - 1) * (SEARCH_FOLDS + 1) / n)))
    size = {r["_block"]: r["n"] for r in d.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a fold
    rows, best = TU.param_search(d, CHURN_FEATURES, "churn", "_block", SEARCH_TRIALS, SEARCH_FOLDS, SEARCH_SPACE, startup=3)
    top = max((r["mean_auc"] for r in rows if all(r[k] == v for k, v in best.items())), default=0.0)
    out = [(r["trial"], r["fold"], sum(v for b, v in size.items() if b < r["fold"]), size.get(r["fold"], 0),
            all(x.low <= r[k] <= x.high for k, x in SEARCH_SPACE.items()), top >= 0.6) for r in rows]
    return spark.createDataFrame(out, "trial long, fold long, n_train long, n_test long, in_space boolean, learned boolean")


@query("isotonic_calibration", views=["subscribers"], sql=f"""
SELECT customer_id, churn, TRUE AS scored FROM subscribers WHERE {_percent_sql('customer_id')} >= 80""")
def isotonic_calibration(spark, sf):
    d = cut_lineage(_churn_frame(spark, sf))
    test = d.filter(~F.col("_train")).drop("_train")
    s = ML.isotonic_calibrated(d.filter("_train").drop("_train"), test, CHURN_FEATURES, "churn", "customer_id", folds=5, max_iter=3)
    return s.select("customer_id", "churn", is_probability().alias("scored"))


@query("permutation_importance", sql="SELECT unnest([" + ", ".join(f"'{x}'" for x in CHURN_FEATURES) + """]) AS feature,
       10::BIGINT AS repeats, TRUE AS in_range, TRUE AS learned""")
def permutation_importance(spark, sf):
    """Ten deals of each of the five features; ``learned`` holds if dealing
    some feature anew costs 0.02 of AUC, as none does for a constant model."""
    d = cut_lineage(_churn_frame(spark, sf))
    m = ML.fitted(ML.gbt_pipeline(CHURN_FEATURES, "churn", max_iter=5, max_depth=3), d.filter("_train"))
    r = cut_lineage(ML.permutation_importance(m, d.filter(~F.col("_train")).drop("_train"), CHURN_FEATURES, "churn", "customer_id", repeats=10))
    return r.select("feature", "repeats", F.coalesce(F.col("importance").between(-1.0, 1.0), F.lit(False)).alias("in_range"),
                    (r.agg(F.max("importance")).scalar() >= 0.02).alias("learned"))


@query("matchup_matrix", views=["games"], sql="""
, t AS (SELECT DISTINCT team_abbr FROM games)
SELECT h.team_abbr AS home, a.team_abbr AS away, TRUE AS scored FROM t h, t a WHERE h.team_abbr <> a.team_abbr""")
def matchup_matrix(spark, sf):
    """Score every ordered team pair with one transform (no per-pair calls),
    by a model of earlier form and each team's latest form."""
    from quarry.operators import joins as J
    from quarry.operators.windows import last_row_per_key
    feats = ["h_pts", "h_win", "a_pts", "a_win"]
    train = cut_lineage(_game_form(spark, sf).select(*feats, "win"))
    m = ML.logistic_pipeline(feats, "win", n=train.count()).fit(train)
    last = last_row_per_key(V.games(spark, sf).select("team_abbr", "game_date", "pts", F.col("win").cast("double").alias("w")), ["team_abbr"], ["game_date"])
    asked = J.ordered_pairs(last.select("team_abbr"), "team_abbr")
    side = lambda p, c: last.select(F.col("team_abbr").alias(c), F.col("pts").alias(f"{p}_pts"), F.col("w").alias(f"{p}_win"))
    return ML.score(m, asked.join(side("h", "home"), "home").join(side("a", "away"), "away")).select("home", "away", is_probability().alias("scored"))


@query("model_bundle", views=["flights"], sql=f"""
, {_FLOWN}
SELECT carrier, count(*) AS n_flights, '1' AS version, 13::BIGINT AS n_features, TRUE AS same FROM flown GROUP BY carrier""")
def model_bundle(spark, sf):
    """Train if there is no bundle, save the delay model with its feature
    list and version, load it back and score with the loaded copy: the same
    probabilities as the model that was saved."""
    path = scratch_path(spark, "model_bundle")
    m, f = _delay_model(spark, sf, most_rounds=3, **SMALL_FIT)
    loaded, meta = ML.train_if_absent(spark, path, lambda: m, DELAY_FEATURES, "1")
    again, _ = ML.train_if_absent(spark, path, lambda: None, DELAY_FEATURES, "1")  # is there: not trained anew
    s = ML.score(again, ML.score(loaded, f, "prob0"))
    return s.groupBy("carrier").agg(F.count(F.lit(1)).alias("n_flights"), F.min(F.col("prob") == F.col("prob0")).alias("same")) \
        .withColumns({"version": F.lit(meta["version"]), "n_features": F.lit(len(meta["features"])).cast("long")})
