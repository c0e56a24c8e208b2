"""Distributed prefix scan, exact percentiles and global ranks against
pandas / numpy on random data with one dominant key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators.ordered import exact_percentiles, global_row_number, ordered_scan


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 4000
    g = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 6, n))      # key 0 holds 60 % of rows
    pdf = pd.DataFrame({"g": g, "v": rng.normal(size=n).round(2), "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_scan_sum_max_min_prod(spark, data):
    pdf, df = data
    d = df.withColumn("p", 1 + F.col("v") / 100)
    r = ordered_scan(d, ["v", "id"], {"s": ("sum", "v"), "mx": ("max", "v"), "mn": ("min", "id"),
                                      "pr": ("prod", "p")}, num_partitions=7).toPandas().sort_values(["v", "id"])
    e = pdf.sort_values(["v", "id"])
    assert np.allclose(r.s.values, e.v.cumsum().values)
    assert np.allclose(r.mx.values, e.v.cummax().values)
    assert (r.mn.values == e.id.cummin().values).all()
    assert np.allclose(r.pr.values, (1 + e.v / 100).cumprod().values)


def test_scan_descending_and_empty_partitions(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [3.0, 1.0, 2.0]}))
    r = ordered_scan(df, [("x", False)], {"c": ("sum", "x")}, num_partitions=16).toPandas().sort_values("x")
    assert r.c.tolist() == [6.0, 5.0, 3.0]


def test_exact_percentiles_per_group(spark, data):
    pdf, df = data
    q = exact_percentiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, num_partitions=5)
    got = q.toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g").v.quantile([0.1, 0.5, 0.99]).unstack()
    assert np.allclose(got[["p10", "p50", "p99"]].values, exp.values)


def test_exact_percentiles_ignores_nulls_and_single_value(spark):
    df = spark.createDataFrame([(1, None), (1, 5.0), (2, 1.0), (2, 3.0)], "g int, v double")
    got = {r["g"]: r["m"] for r in exact_percentiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {1: 5.0, 2: 2.0}


def test_global_row_number_is_dense_and_ordered(spark, data):
    pdf, df = data
    r = global_row_number(df, [("v", False), "id"], "rk", num_partitions=6).toPandas()
    assert sorted(r.rk) == list(range(1, len(pdf) + 1))
    exp = pdf.sort_values(["v", "id"], ascending=[False, True]).id.tolist()
    assert r.sort_values("rk").id.tolist() == exp
