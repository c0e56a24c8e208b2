"""The adaptive search on known surfaces, and fits along time."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import models as ML
from quarry.operators import tuning as TU
from quarry.operators.metrics import auc_exact

SPACE = {"a": TU.Dimension(0.0, 1.0), "b": TU.Dimension(0.001, 1.0, log=True), "c": TU.Dimension(1, 9, whole=True), "d": TU.Dimension(0.0, 1.0),
         "e": TU.Dimension(-5.0, 5.0)}


def surface(p):
    """Best (0) at one point; every parameter matters."""
    import math

    return -((p["a"] - 0.3) ** 2 + (math.log10(p["b"]) + 1.5) ** 2 / 9 + ((p["c"] - 6) / 8) ** 2 + (p["d"] - 0.8) ** 2 + (p["e"] / 10) ** 2)


def test_search_beats_random_draws():
    ours, chance = [], []
    for seed in range(12):
        ours.append(TU.search(SPACE, surface, 50, seed=seed).best[1])
        rnd = random.Random(1000 + seed)
        chance.append(max(surface({k: d.outer(rnd.random()) for k, d in SPACE.items()}) for _ in range(50)))
    assert sum(ours) > 0.6 * sum(chance)  # both are below 0
    assert sum(a > b for a, b in zip(ours, chance)) >= 8


def test_proposals_stay_in_bounds_and_failed_trials_are_worst():
    s = TU.ParzenSampler(SPACE, startup=3, seed=1)
    for k in range(40):
        p = s.propose()
        assert all(d.low <= p[x] <= d.high for x, d in SPACE.items()) and isinstance(p["c"], int)
        s.tell(p, float("nan") if k % 2 else surface(p))
    assert s.best[1] == max(surface(p) for p, v in s.trials if v > -100)
    assert {TU.Dimension(1, 3, whole=True).outer(u / 100) for u in range(101)} == {1, 2, 3}


@pytest.fixture(scope="module")
def daily(spark):
    df = spark.range(4000).select((F.col("id") / 10).cast("int").alias("day"), F.randn(1).alias("x"), F.randn(2).alias("z"))
    # what x says turns round half-way, so a model of the wrong span is worse than chance
    sign = F.when(F.col("day") < 200, 1.0).otherwise(-1.0)
    df = df.withColumn("y", (sign * F.col("x") + F.randn(3) > 0).cast("int"))
    return df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day"))).cache()


def test_walk_forward_equals_fits_made_one_by_one(spark, daily):
    import datetime as dt

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    folds = [{"fold": k + 1, "train_start": day(s), "train_end": day(s + 90), "test_start": day(s + 95), "test_end": day(s + 125)}
             for k, s in enumerate((0, 60, 230))]
    fit = ML.logistic_pipeline(["x", "z"], "y").fit
    got = TU.walk_forward_fit(daily, folds, "date", "y", fit).cache()
    for f in folds:
        train = daily.where((F.col("date") >= f["train_start"]) & (F.col("date") < f["train_end"]))
        test = daily.where((F.col("date") >= f["test_start"]) & (F.col("date") < f["test_end"]))
        want = auc_exact(ML.score(fit(train), test), "prob", "y").first()
        mine = got.where(F.col("fold") == f["fold"]).agg(F.min("fold_auc").alias("lo"), F.max("fold_auc").alias("hi"), F.count(F.lit(1)).alias("n")).first()
        assert mine["n"] == want["n"] == 300 and abs(mine["lo"] - want["auc"]) < 1e-9 and mine["lo"] == mine["hi"] > 0.7
    none = TU.walk_forward_fit(daily, [], "date", "y", fit)
    assert none.count() == 0 and {"prob", "fold", "fold_auc"} <= set(none.columns)


def test_param_search_values_trials_by_their_folds(spark, daily):
    df = daily.where("day < 200").withColumn("block", (F.col("day") / 50).cast("int")).cache()
    space = {"max_iter": TU.Dimension(1, 3, whole=True), "max_depth": TU.Dimension(1, 3, whole=True), "step": TU.Dimension(0.1, 0.3, log=True),
             "min_instances": TU.Dimension(1, 20, whole=True), "min_gain": TU.Dimension(0.0, 0.4)}
    rows, best = TU.param_search(df, ["x", "z"], "y", "block", trials=4, folds=3, space=space, startup=2)
    assert len(rows) == 12 and set(best) == set(space)
    means = {r["trial"]: r["mean_auc"] for r in rows}
    top = max(means, key=means.get)
    assert all(r[k] == v for r in rows if r["trial"] == top for k, v in best.items()) and means[top] > 0.65
    for t in means:
        aucs = [r["auc"] for r in rows if r["trial"] == t]
        assert abs(sum(aucs) / 3 - means[t]) < 1e-12
