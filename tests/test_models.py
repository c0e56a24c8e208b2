"""Model operators: quality bounds that can fail on a learnable label, and
exact properties elsewhere. (The registered queries have oracles.)"""

import pytest
from pyspark.sql import functions as F

from quarry.operators import models as ML
from quarry.operators.metrics import auc_exact
from quarry.plans import ml

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def churn(spark):
    return ml._churn_frame(spark, SF01).cache()


def test_churn_models_learn(spark, churn):
    train, test = churn.filter("_train"), churn.filter("not _train")
    n = train.count()
    for pipe in (ML.logistic_pipeline(ml.CHURN_FEATURES, "churn", n=n), ML.forest_pipeline(ml.CHURN_FEATURES, "churn", trees=20, depth=5),
                 ML.gbt_pipeline(ml.CHURN_FEATURES, "churn", max_iter=5, max_depth=3)):
        r = auc_exact(ML.score(pipe.fit(train), test), "prob", "churn").first()
        assert r["auc"] > 0.62 and r["n"] == test.count()


def test_calibration_keeps_null_and_equal_rows(spark, churn):
    train, test = churn.filter("_train").drop("_train"), churn.filter("not _train").drop("_train").limit(40)
    odd = test.withColumn("tenure", F.lit(None).cast("double")).limit(3)
    s = ML.isotonic_calibrated(train, test.unionByName(test).unionByName(odd), ml.CHURN_FEATURES, "churn", "customer_id", folds=2, max_iter=2)
    rows = s.collect()
    assert len(rows) == 83 and all(0 <= r["prob"] <= 1 for r in rows)


def test_forms_look_back_only(spark):
    g = ml._game_form(spark, SF01, games_back=3).toPandas()
    log = __import__("quarry.plans.views", fromlist=["games"]).games(spark, SF01).toPandas().sort_values(["team_id", "game_date"])
    log["f"] = log.groupby("team_id").pts.transform(lambda s: s.shift().rolling(3, min_periods=1).mean()).fillna(0.0)
    want = log[log.is_home == 1].set_index("game_id").f
    assert (g.set_index("game_id").h_pts - want).abs().max() < 1e-9 and len(g) == len(want)


def test_advice_follows_tiers_and_effects_stand_alone(spark):
    df = spark.createDataFrame([(0.7, 12.0, 19), (0.3, 5.0, 9), (0.1, 7.0, 12)], "p double, month double, hour int")
    r = ML.advise(df, "p", {"x": 100 * F.col("p"), "season": ML.season_effect(F.col("month")), "hour": ML.hour_effect(F.col("hour"))}).collect()
    assert [x["tier"] for x in r] == ["High", "Medium", "Low"] and len({x["advice"] for x in r}) == 3
    assert [x["factors"] for x in r] == [{"x": 70.0, "season": 3.0, "hour": 3.5}, {"x": 30.0, "season": -1.0, "hour": -1.5},
                                         {"x": 10.0, "season": 3.0, "hour": 0.0}]


def test_importance_finds_the_feature_that_matters(spark, churn):
    df = spark.range(1200).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("y", (F.col("a") > 0.4).cast("int")).cache()
    m = ML.gbt_pipeline(["a", "b"], "y", max_iter=3, max_depth=2).fit(df)
    r = {x["feature"]: x for x in ML.permutation_importance(m, df, ["a", "b"], "y", "id", repeats=6).collect()}
    assert r["a"]["importance"] > 0.4 and abs(r["b"]["importance"]) < 0.02 and r["a"]["repeats"] == 6
    assert 0 < r["a"]["deviation"] < 0.1
    size = ML.permutation_importance(m, df, ["a", "b"], "y", "id", repeats=3, signed=False).collect()
    assert all(x["importance"] >= 0 for x in size)


def test_restarts_are_no_worse_than_single_fits(spark):
    from pyspark.ml.clustering import KMeans

    df = spark.range(900).select("id", (F.col("id") % 9 * 3 + F.randn(1)).alias("x"), (F.col("id") % 3 * 5 + F.randn(2)).alias("y")).cache()
    centres, cost = ML.kmeans_restarts(df, ["x", "y"], k=5, restarts=12)
    a = ML.assemble(["x", "y"]).transform(df)
    single = min(KMeans(k=5, seed=s).fit(a).summary.trainingCost for s in (1, 2, 3))
    assert centres.shape == (12, 5, 2) and cost.min() <= single * 1.0001
    out = ML.kmeans(df, ["x", "y"], k=5, restarts=12).toPandas()
    means = out.groupby("segment")[["x", "y"]].mean().to_numpy()
    d = ((out[["x", "y"]].to_numpy()[:, None] - means[None]) ** 2).sum(-1)
    assert (d.argmin(1) == out.segment).all() and abs(d.min(1).sum() - cost.min()) < 1e-6 * cost.min()


def test_restarts_of_few_equal_and_no_rows(spark):
    same = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert sorted(str(r["segment"]) for r in ML.kmeans(same, ["x"], k=2, restarts=3).collect()) == ["0", "0", "None"]
    assert ML.kmeans(same.limit(0), ["x"], k=2, restarts=3).count() == 0


def test_categories_split_as_sets_and_fits_stop(spark):
    """Delays at hours that no two cuts of an order part: sets do."""
    late = [1, 4, 6, 9, 11, 14, 17, 20, 22]
    df = spark.range(6000).select("id", (F.xxhash64("id", F.lit(3)) % 24 + 24).cast("int").alias("h"), F.rand(5).alias("noise"))
    df = df.withColumn("hour", (F.col("h") % 24).cast("double")).withColumn("y", (F.col("hour").isin(late) == (F.rand(6) < 0.9)).cast("int"))
    df = df.withColumn("valid", F.col("id") % 5 == 0).withColumn("test", F.col("id") % 7 == 0).cache()
    train, test = df.where("not test"), df.where("test")
    got = {}
    for name, categories in (("sets", ["hour"]), ("order", [])):
        m, rounds = ML.patient_gbt(train, ["hour", "noise"], "y", "valid", categories, most_rounds=60, patience=4, stage=6, max_depth=2)
        assert 1 <= rounds <= 60 and m.stages[-1].getNumTrees == rounds
        got[name] = auc_exact(ML.score(m, ML.with_category_text(test, categories)), "prob", "y").first()["auc"], rounds
    assert got["sets"][0] > got["order"][0] and got["sets"][0] > 0.85 and got["sets"][1] < 60


def _parts_of_fits(monkeypatch):
    """Rows by partition of all that boosted trees are fitted on and held against."""
    seen = []
    fit = ML.GBTClassifier._fit
    monkeypatch.setattr(ML.GBTClassifier, "_fit", lambda self, d: (
        seen.append([r["n"] for r in d.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]), fit(self, d))[1])
    return seen


def test_fits_take_rows_dealt_evenly(spark, monkeypatch):
    """Behind an exchange by a hot key and merged by AQE all rows were in one task."""
    monkeypatch.setattr(ML, "ROWS_A_PART", 500)
    seen = _parts_of_fits(monkeypatch)
    df = spark.range(6000).select("id", (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    df = df.withColumns({"y": (F.col("b") > 3).cast("int"), "valid": F.col("id") % 3 == 0}).repartition("a")
    ML.patient_gbt(df, ["a", "b"], "y", "valid", most_rounds=2, stage=2, max_depth=2)
    ML.fitted(ML.gbt_pipeline(["a", "b"], "y", max_iter=2, max_depth=2), df)
    assert [sum(n) for n in seen] == [4000, 6000] and [len(n) for n in seen] == [8, 12]
    assert max(map(max, seen)) < 600
    assert ML.dealt(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["batch_score", "boosted_trees_noshow"])
def test_queries_fit_on_bounded_parts(spark, monkeypatch, name):
    from quarry.plans.catalog import load_all

    monkeypatch.setattr(ML, "ROWS_A_PART", 300)
    seen = _parts_of_fits(monkeypatch)
    load_all()[name].build(spark, "/root/testdata/sf0.001").count()
    assert seen and max(map(max, seen)) < 400


def test_rare_categories_share_a_number(spark):
    df = spark.createDataFrame([(float(x % 50 if x < 400 else 1000 + x), 1) for x in range(500)] + [(None, 1)], "c double, y int")
    stage, = ML.category_stages(df, ["c"], most=8)
    out = stage.transform(ML.with_category_text(df, ["c"]))
    assert out.select("c_cat").distinct().count() == 8 and out.where("c is null").first()["c_cat"] == 7.0


def test_bundle_is_trained_once(spark, churn, tmp_path):
    fits = []

    def train():
        fits.append(1)
        return ML.logistic_pipeline(["tenure"], "churn", n=100).fit(churn)
    for _ in range(2):
        _, meta = ML.train_if_absent(spark, str(tmp_path / "b"), train, ["tenure"], "1")
    assert len(fits) == 1 and meta["features"] == ["tenure"]
