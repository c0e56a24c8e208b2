"""Window operators against pandas semantics (rolling min_periods, ewm,
qcut, RSI) and the salted top-n against a plain sort."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import windows as W


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k, n in (("a", 300), ("b", 40), ("c", 3)):
        x = np.cumsum(rng.normal(size=n)) + 50
        x[rng.random(n) < 0.05] = np.nan
        for i, v in enumerate(x):
            rows.append((k, i, None if np.isnan(v) else float(v)))
    pdf = pd.DataFrame(rows, columns=["k", "t", "x"])
    return pdf, spark.createDataFrame(pdf, "k string, t int, x double")


def _by(pdf, col):
    return pdf.sort_values(["k", "t"])[col].to_numpy(dtype=float)


def test_rolling_min_periods(spark, series):
    pdf, df = series
    got = df.select("k", "t", W.rolling("x", "k", "t", 5, 3).alias("r"),
                    W.rolling("x", "k", "t", 5, 3, include_current=False).alias("p")).toPandas()
    exp_r = pdf.sort_values(["k", "t"]).groupby("k").x.transform(lambda s: s.rolling(5, min_periods=3).mean())
    exp_p = pdf.sort_values(["k", "t"]).groupby("k").x.transform(lambda s: s.shift(1).rolling(5, min_periods=3).mean())
    assert np.allclose(_by(got, "r"), exp_r.to_numpy(dtype=float), equal_nan=True)
    assert np.allclose(_by(got, "p"), exp_p.to_numpy(dtype=float), equal_nan=True)


def test_ema_adjust_false(spark, series):
    pdf, df = series
    full = pdf.dropna()
    d = spark.createDataFrame(full, "k string, t int, x double")
    got = W.ema(d, "x", "k", "t", 12, "e").toPandas()
    exp = full.sort_values(["k", "t"]).groupby("k").x.transform(lambda s: s.ewm(span=12, adjust=False).mean())
    assert np.allclose(_by(got, "e"), exp.to_numpy(), rtol=1e-10)


def test_ewm_adjusted_with_nulls(spark, series):
    pdf, df = series
    got = W.ewm_adjusted(df, "x", "k", "t", 10, 5, "e").toPandas()
    exp = pdf.sort_values(["k", "t"]).groupby("k").x.transform(lambda s: s.ewm(span=10, min_periods=5).mean())
    assert np.allclose(_by(got, "e"), exp.to_numpy(dtype=float), rtol=1e-9, equal_nan=True)


def test_quantile_buckets_equal_qcut(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"d": rng.integers(0, 4, 2000), "x": rng.integers(0, 30, 2000).astype(float)})
    df = spark.createDataFrame(pdf)
    got = W.quantile_buckets(df.withColumn("i", F.monotonically_increasing_id()), "d", "x", 10).toPandas()
    exp = pdf.groupby("d").x.transform(lambda s: pd.qcut(s, 10, labels=False, duplicates="drop"))
    e = pdf.assign(b=exp).groupby(["d", "x"]).b.first()
    g = got.groupby(["d", "x"]).bucket.first()
    assert (g.sort_index() == e.sort_index()).all()


def test_rsi_matches_pandas(spark, series):
    pdf, df = series
    full = pdf.dropna()
    d = spark.createDataFrame(full, "k string, t int, x double")
    got = d.select("k", "t", W.rsi("x", "k", "t", 14).alias("r")).toPandas()

    def ref(s):
        delta = s.diff()
        gain = delta.clip(lower=0).rolling(14, min_periods=14).mean()
        loss = (-delta.clip(upper=0)).rolling(14, min_periods=14).mean()
        return 100 - 100 / (1 + gain / loss.replace(0, np.nan))
    exp = full.sort_values(["k", "t"]).groupby("k").x.transform(ref)
    assert np.allclose(_by(got, "r"), exp.to_numpy(dtype=float), equal_nan=True)


def test_top_n_per_hot_key(spark):
    pdf = pd.DataFrame({"k": ["hot"] * 5000 + ["cold"] * 10, "v": np.arange(5010) % 977, "id": np.arange(5010)})
    df = spark.createDataFrame(pdf)
    got = W.top_n_per_key(df, ["k"], [F.col("v").desc()], 5, ["id"]).toPandas()
    for k, grp in pdf.groupby("k"):
        exp = grp.sort_values(["v", "id"], ascending=[False, True]).head(5).id.tolist()
        assert got[got.k == k].sort_values("_rank").id.tolist() == exp


def test_group_mean_encode_leaves_rows_where_they_are(spark):
    """The few means are broadcast; the rows were shuffled by a key of few values."""
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 1), ("b", None)], "k string, y int").checkpoint()
    r = W.group_mean_encode(df, "k", "y", "m", default=0.5)
    assert "SortMergeJoin" not in r._jdf.queryExecution().executedPlan().toString()
    assert sorted((str(x["k"]), x["m"]) for x in r.collect()) == [("None", 0.5), ("a", 0.5), ("a", 0.5), ("b", 0.5)]


def test_group_mean_encode_leave_one_out(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 1), ("b", 0)], "k string, y int")
    r = W.group_mean_encode(df, "k", "y", "m", leave_one_out=True).orderBy("k", "y").toPandas()
    assert r.m.tolist() == [1.0, 0.5, 0.5, 0.0]


def test_ema_and_ewm_long_keys(spark):
    """Keys far longer than the closed-form range of one block."""
    rng = np.random.default_rng(9)
    n = 9000
    x = np.cumsum(rng.normal(size=n)) + 100
    x_n = x.copy()
    x_n[rng.random(n) < 0.03] = np.nan
    pdf = pd.DataFrame({"k": "long", "t": np.arange(n), "x": x, "xn": x_n})
    df = spark.createDataFrame(pdf, "k string, t long, x double, xn double")
    got = W.ewm_adjusted(W.ema(df, "x", "k", "t", 9, "e"), "xn", "k", "t", 10, 5, "w").toPandas().sort_values("t")
    assert np.allclose(got.e.values, pdf.x.ewm(span=9, adjust=False).mean().values, rtol=1e-9)
    assert np.allclose(got.w.values, pdf.xn.ewm(span=10, min_periods=5).mean().values, rtol=1e-9, equal_nan=True)


def test_blocked_windows_equal_per_key_windows(spark):
    """A hot key cut into small blocks with halos gives the same rolling,
    lag and lead values as one window over the whole key."""
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": ["hot"] * 3000 + ["cold"] * 40, "t": np.r_[np.arange(3000), np.arange(40)],
                        "x": rng.normal(size=3040)})
    df = spark.createDataFrame(pdf, "k string, t long, x double")
    b = W.blocked(df, "k", "t", back=19, forward=5, block_rows=250)
    kb = ["k", "_blk"]
    got = (b.select("k", "t", "_own", W.rolling("x", kb, "_idx", 20, 10).alias("r"),
                    F.lag("x", 3).over(W._w(kb, "_idx")).alias("l3"), F.lead("x", 5).over(W._w(kb, "_idx")).alias("f5"))
            .filter("_own").toPandas().sort_values(["k", "t"]))
    ref = pdf.sort_values(["k", "t"]).copy()
    g = ref.groupby("k").x
    ref["r"] = g.transform(lambda s: s.rolling(20, min_periods=10).mean())
    ref["l3"], ref["f5"] = g.shift(3), g.shift(-5)
    assert len(got) == len(ref)
    for c in ["r", "l3", "f5"]:
        assert np.allclose(got[c].to_numpy(dtype=float), ref[c].to_numpy(dtype=float), equal_nan=True), c


def test_ema_ewm_with_scan_index_on_hot_key(spark):
    """Row positions from the grouped prefix scan instead of a per-key sort."""
    from quarry.operators.ordered import grouped_running
    rng = np.random.default_rng(12)
    n = 6000
    x = np.cumsum(rng.normal(size=n)) + 100
    xn = x.copy()
    xn[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"k": ["hot"] * (n - 50) + ["cold"] * 50, "t": np.arange(n), "x": x, "xn": xn})
    df = spark.createDataFrame(pdf, "k string, t long, x double, xn double")
    ix = grouped_running(df.withColumn("_one", F.lit(1).cast("long")), ["k"], ["t"], {"i": "_one"})
    got = W.ewm_adjusted(W.ema(ix, "x", "k", "t", 9, "e", index="i"), "xn", "k", "t", 10, 5, "w", index="i")
    got = got.toPandas().sort_values(["k", "t"])
    ref = pdf.sort_values(["k", "t"])
    e = ref.groupby("k").x.transform(lambda s: s.ewm(span=9, adjust=False).mean())
    w = ref.groupby("k").xn.transform(lambda s: s.ewm(span=10, min_periods=5).mean())
    assert np.allclose(got.e.values, e.values, rtol=1e-9)
    assert np.allclose(got.w.values, w.to_numpy(dtype=float), rtol=1e-9, equal_nan=True)


def test_keyed_frame_is_blocked_at_every_size(spark):
    pdf = pd.DataFrame({"k": ["hot"] * 700 + ["cold"] * 30, "t": np.r_[np.arange(700), np.arange(30)],
                        "x": np.random.default_rng(1).normal(size=730)})
    df = spark.createDataFrame(pdf, "k string, t long, x double")
    f, kk, oo, own = W.keyed_frame(df, "k", "t", back=9, block_rows=100)
    assert kk == ["k", "_blk"]
    got = f.withColumn("r", W.rolling("x", kk, oo, 10, 5)).filter(own).toPandas().sort_values(["k", "t"])
    exp = pdf.sort_values(["k", "t"]).groupby("k").x.transform(lambda s: s.rolling(10, min_periods=5).mean())
    assert np.allclose(got.r.values, exp.to_numpy(dtype=float), equal_nan=True)
    f2, kk2, _, _ = W.keyed_frame(df, "k", "t", back=9, block_rows=1000)
    assert kk2 == ["k", "_blk"]
