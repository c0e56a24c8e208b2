"""Boosted trees on compact rows against Spark's own fit, and what the registered fits ask for."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import boosting as B
from quarry.operators import models as ML
from quarry.plans import ml

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    d = spark.range(4000).select("id", F.rand(1).alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.xxhash64("id") % 12 + 12).cast("double").alias("c"))
    y = (F.col("a") + F.col("c").isin(3, 7, 11, 14, 20).cast("double") + F.randn(2) / 3 > 0.8).cast("int")
    d = ML.with_category_text(d.withColumns({"y": y, "w": F.when(F.col("id") % 3 == 0, 0.5).otherwise(1.0)}), ["c"])
    front = ML.Pipeline(stages=[*ML.category_stages(d, ["c"]), ML.assemble(["c_cat", "a", "b"])]).fit(d)
    return front.transform(d).select("id", "features", "y", "w").cache()


def _scored(m, d):
    return np.array([r["p"] for r in m.transform(d).orderBy("id").select(vector_to_array("probability")[1].alias("p")).collect()])


@pytest.mark.parametrize("weight", [None, "w"])
def test_same_model_as_sparks_fit(spark, rows, weight, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "CHANGES", 3)  # checkpoints on the way
    monkeypatch.setattr(B, "ROWS_A_BLOCK", 700)  # and several blocks, by executors
    kw = dict(labelCol="y", maxIter=8, maxDepth=4, maxBins=64, minInstancesPerNode=30, seed=1) | ({"weightCol": weight} if weight else {})
    own, other = B.BoostedTrees(**kw).fit(rows.repartition(3)), GBTClassifier(**kw).fit(rows)
    assert own.getNumTrees == 8 and np.abs(_scored(own, rows) - _scored(other, rows)).max() < 1e-9
    assert np.abs(own.featureImportances.toArray() - other.featureImportances.toArray()).max() < 1e-9
    own.save(str(tmp_path / "m"))
    assert (_scored(GBTClassificationModel.load(str(tmp_path / "m")), rows) == _scored(own, rows)).all()


def test_fit_stops_at_the_least_loss_of_the_held_rows(spark, rows):
    train, held = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    kw = dict(labelCol="y", maxDepth=5, maxBins=64, stepSize=0.6, seed=1)
    m = B.BoostedTrees(**kw, maxIter=60, held=held, patience=6, look=4).fit(train)
    loss = GBTClassifier(**kw, maxIter=30).fit(train).evaluateEachIteration(held)
    assert m.getNumTrees == 1 + int(np.argmin(loss)) < 30


def test_many_values_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "POINTS", 200)
    monkeypatch.setattr(B, "ROWS_A_BLOCK", 500)
    d = spark.range(5000).select("id", F.rand(4).alias("x"), F.lit(1.0).alias("one"))
    d = ML.assemble(["x", "one"]).transform(d.withColumn("y", (F.col("x") < 0.3).cast("int"))).cache()
    m = B.BoostedTrees(labelCol="y", maxIter=2, maxDepth=2, maxBins=32).fit(d)
    assert m.transform(d).where("prediction <> y").count() < 5000 / 32
    for bad in (d.withColumn("y", F.lit(2)), d.withColumn("y", F.lit(None).cast("int"))):
        with pytest.raises(Exception, match="labels"):
            B.BoostedTrees(labelCol="y", maxIter=1).fit(bad)
    nan = ML.assemble(["x", "one"]).transform(d.drop("features").withColumn("x", F.when(F.col("id") > 9, F.col("x"))))
    with pytest.raises(Exception, match="features"):
        B.BoostedTrees(labelCol="y", maxIter=1).fit(nan)
    with pytest.raises(ValueError, match="rows"):
        B.BoostedTrees(labelCol="y", maxIter=1).fit(d.limit(0))


class _Asked(Exception):
    pass


def _asked(self, df):
    raise _Asked(self)


@pytest.mark.parametrize("build, params, patience", [
    (ml.boosted_trees_delay, {"maxIter": 500, "maxDepth": 6, "stepSize": 0.05, "minInstancesPerNode": 500}, 50),
    (ml.boosted_trees_noshow, {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, "minInstancesPerNode": 20}, None)])
def test_registered_fits_have_the_rounds_of_the_reference(spark, monkeypatch, build, params, patience):
    monkeypatch.setattr(ML.GBTClassifier, "_fit", _asked)
    with pytest.raises(_Asked) as e:
        build(spark, SF001)
    fit = e.value.args[0]
    assert {k: fit.getOrDefault(k) for k in params} == params
    assert fit.patience == patience if patience else fit.held is None
