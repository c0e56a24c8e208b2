"""Metric identities and brute-force checks (AUC with ties, confusion,
concentration, threshold sweep, stratified split, backtest curve)."""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quarry.operators import aggregates as A
from quarry.operators import backtest as B
from quarry.operators import metrics as M


def _auc(spark, scores, labels):
    df = spark.createDataFrame(pd.DataFrame({"s": scores, "y": labels}))
    return M.auc_exact(df, "s", "y").first()["auc"]


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_identities(spark):
    y = [0, 0, 1, 1, 0, 1]
    assert _auc(spark, [0.1, 0.2, 0.8, 0.9, 0.3, 0.7], y) == 1.0
    assert _auc(spark, [0.9, 0.8, 0.1, 0.2, 0.7, 0.3], y) == 0.0
    assert _auc(spark, [0.5] * 6, y) == 0.5


def test_auc_ties_brute_force(spark):
    rng = np.random.default_rng(11)
    s = rng.integers(0, 8, 300).astype(float) / 8
    y = (rng.random(300) < 0.3 + 0.4 * s).astype(int)
    assert abs(_auc(spark, s.tolist(), y.tolist()) - brute_auc(s, y)) < 1e-12


def test_auc_by_group(spark):
    pdf = pd.DataFrame({"g": [1] * 4 + [2] * 4, "s": [0.1, 0.4, 0.35, 0.8, 0.5, 0.5, 0.2, 0.9],
                        "y": [0, 0, 1, 1, 1, 0, 0, 1]})
    got = {r["g"]: r["auc"] for r in M.auc_exact(spark.createDataFrame(pdf), "s", "y", ["g"]).collect()}
    for g, grp in pdf.groupby("g"):
        assert abs(got[g] - brute_auc(grp.s.tolist(), grp.y.tolist())) < 1e-12


def test_confusion_cells_sum_to_n(spark):
    df = spark.range(500).select(((F.col("id") % 7) / 7).alias("p"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    c = M.confusion(df, "p", "y", 0.5).first()
    assert c.tp + c.fp + c.fn + c.tn == 500


def test_threshold_sweep_matches_confusion(spark):
    df = spark.range(400).select(((F.col("id") * 37 % 100) / 100).alias("p"), (F.col("id") % 2).cast("int").alias("y"))
    sw = {r["threshold"]: r for r in M.threshold_sweep(df, "p", "y", [0.3, 0.5]).collect()}
    c = M.confusion(df, "p", "y", 0.5).first()
    assert (sw[0.5].tp, sw[0.5].fp, sw[0.5].fn) == (c.tp, c.fp, c.fn)


def test_gini_and_top_share(spark):
    eq = spark.createDataFrame([(5.0,)] * 100, "x double")
    assert abs(A.gini(eq, "x").first()["gini"]) < 1e-12
    assert abs(A.top_share(eq, "x", {"t": 0.1}).first()["t"] - 0.1) < 1e-12
    vals = np.arange(1, 101, dtype=float)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    xs = np.sort(vals)
    n = len(xs)
    exp = (2 * np.sum(np.arange(1, n + 1) * xs)) / (n * xs.sum()) - (n + 1) / n
    assert abs(A.gini(df, "x").first()["gini"] - exp) < 1e-12
    assert abs(A.top_share(df, "x", {"t": 0.2}).first()["t"] - xs[-20:].sum() / xs.sum()) < 1e-12


def test_stratified_split_keeps_label_share(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    s = M.stratified_split(df, "id", "y", 0.8).groupBy("y", "split").count().toPandas()
    t = s.pivot(index="y", columns="split", values="count")
    assert t.loc[1, "train"] == 200 and t.loc[0, "train"] == 600


def test_equity_curve_and_drawdown(spark):
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=6).date,
                        "daily_ret": [0.1, -0.2, 0.05, 0.3, -0.1, 0.0]})
    c = B.equity_curve(spark.createDataFrame(pdf), "date").toPandas().sort_values("date")
    cum = (1 + pdf.daily_ret).cumprod()
    assert np.allclose(c.cum.values, cum.values)
    assert np.allclose(c.drawdown.values, (cum / cum.cummax() - 1).values)


def test_walk_forward_fold_identities(spark, registry):
    from quarry.plans import learning as L
    f = registry["walk_forward_folds"].build(spark, "/root/testdata/sf0.01").toPandas()
    assert len(f) > 0
    assert (f.fold.sort_values().tolist() == list(range(1, len(f) + 1)))
    gap = (pd.to_datetime(f.test_start) - pd.to_datetime(f.train_end)).dt.days
    span = (pd.to_datetime(f.train_end) - pd.to_datetime(f.train_start)).dt.days
    test_span = (pd.to_datetime(f.test_end) - pd.to_datetime(f.test_start)).dt.days
    assert (gap == L.WF_EMBARGO).all() and (span == L.WF_TRAIN_DAYS).all() and (test_span == L.WF_TEST_DAYS).all()
    assert (f.n_train >= L.WF_MIN_TRAIN).all() and (f.n_test >= L.WF_MIN_TEST).all()
