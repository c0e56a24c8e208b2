"""Model fitting, scoring, calibration and importance on Spark ML.

Fits are distributed Spark ML jobs (tree histograms and gradient steps are
computed by executors over partitions); the driver only holds the model.
Probabilities are taken with ``vector_to_array`` so no Python UDF runs.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import round_to
from quarry.operators.boosting import BoostedTrees
from quarry.operators.metrics import auc_exact
from quarry.operators.ordered import global_row_number
from quarry.session import cut_lineage


def assemble(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


#: Rows that a task of a fit takes at most, and those for which a further task is worth its while.
ROWS_A_PART, ROWS_WORTH_A_PART = 200_000, 10_000


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over tasks, in parts that do not grow with the
    table. A fit keeps its rows in memory by partition and reads them again
    for every level of every tree; behind a join on a key of few values, or
    merged by AQE (which knows compressed bytes, not tree points), a few
    partitions would hold all rows however large the table is."""
    n = df.count()
    parts = max(1, math.ceil(n / ROWS_A_PART), min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / ROWS_WORTH_A_PART)))
    return df.repartition(parts)


def fitted(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """``pipeline`` fitted on the rows of ``df``, dealt evenly."""
    return pipeline.fit(dealt(df))


def gbt_pipeline(features: Sequence[str], label: str, categorical: Sequence[str] = (), max_iter: int = 200,
                 max_depth: int = 5, step: float = 0.1, min_instances: int = 1, weight: str | None = None,
                 max_bins: int = 64, seed: int = 42, validation: str | None = None, min_gain: float = 0.0) -> Pipeline:
    """Gradient-boosted trees; string categoricals are indexed first. Rows
    with a true ``validation`` column decide when to stop before ``max_iter``."""
    stages, cols = [], []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"))
        cols.append(f"{c}_idx")
    cols += [c for c in features if c not in categorical]
    stages.append(assemble(cols))
    # early stop by Spark's rule is Spark's fit alone
    gbt = (GBTClassifier if validation else BoostedTrees)(
        labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=max_depth, minInfoGain=min_gain,
        stepSize=step, minInstancesPerNode=min_instances, maxBins=max_bins, seed=seed)
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setValidationIndicatorCol(validation)
    stages.append(gbt)
    return Pipeline(stages=stages)


#: Values of a numeric category at most; rarer ones share the last.
MOST_CATEGORIES = 32


def category_stages(df: DataFrame, categories: Sequence[str], most: int = MOST_CATEGORIES) -> list:
    """Stages that make ``{c}_cat`` of each column: whole numbers with the
    metadata by which trees split on sets of values rather than on an order.
    The ``most - 1`` most frequent values (ties to the smaller) keep a number
    each, all others and nulls share one, so the bins of a tree are bounded
    however many values there are. The driver sees ``most`` values a column."""
    stages = []
    for c in categories:
        top = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), c).limit(most - 1)
        labels = [str(r[c]) for r in top.collect()]
        stages.append(StringIndexerModel.from_labels(labels, inputCol=f"_{c}_text", outputCol=f"{c}_cat", handleInvalid="keep"))
    return stages


def with_category_text(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_{c}_text": F.col(c).cast("string") for c in categories})


def patient_gbt(df: DataFrame, features: Sequence[str], label: str, validation: str, categories: Sequence[str] = (), most_rounds: int = 500,
                patience: int = 50, stage: int = 5, max_depth: int = 5, step: float = 0.1, min_instances: int = 1,
                seed: int = 42) -> tuple[PipelineModel, int]:
    """(model, rounds): boosted trees that stop by themselves.

    Every ``stage`` rounds the loss of the rows with a true ``validation`` is
    taken after each round; once it was least ``patience`` rounds before the
    last, the model is the trees up to there. No tree is fitted twice.
    ``categories`` are split as sets (``category_stages``), other features by
    order. Score rows that went through ``with_category_text``.
    """
    numeric = [c for c in features if c not in categories]
    train, held = df.where(~F.col(validation)), df.where(F.col(validation))
    front = Pipeline(stages=[*category_stages(train, categories), assemble([*[f"{c}_cat" for c in categories], *numeric])]) \
        .fit(with_category_text(train, categories))
    x, y = (dealt(front.transform(with_category_text(d, categories)).select("features", label)) for d in (train, held))
    model = BoostedTrees(labelCol=label, featuresCol="features", maxIter=most_rounds, maxDepth=max_depth, stepSize=step, minInstancesPerNode=min_instances,
                         maxBins=max(64, MOST_CATEGORIES + 1), seed=seed, held=y, patience=patience, look=stage).fit(x)
    return PipelineModel(stages=[*front.stages, model]), model.getNumTrees


def logistic_pipeline(features: Sequence[str], label: str, c_inverse_reg: float = 1.0, n: int = 1) -> Pipeline:
    """L2 logistic regression; regParam = 1 / (C * n) mirrors the usual C."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", regParam=1.0 / (c_inverse_reg * max(n, 1)),
                            elasticNetParam=0.0, standardization=False)
    return Pipeline(stages=[assemble(features), lr])


def forest_pipeline(features: Sequence[str], label: str, trees: int = 30, depth: int = 6, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[assemble(features),
                            RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)])


def score(model: PipelineModel, df: DataFrame, out: str = "prob") -> DataFrame:
    """``df`` with the positive class's probability as a plain double column."""
    return model.transform(df).select(*[c for c in df.columns if c != out], vector_to_array("probability")[1].alias(out))


def kmeans_restarts(df: DataFrame, features: Sequence[str], k: int = 4, restarts: int = 20, most_steps: int = 100, sample: int = 2_000,
                    tolerance: float = 1e-9, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(centres (restart, k, feature), cost of each restart): Lloyd's steps of
    all restarts at once, each step one pass over the rows that sums a row for
    every restart's nearest centre. Starts are k-means++ draws from ``sample``
    rows picked by a hash. It ends when no centre moves. A centre without rows
    stays where it is."""
    from pyspark.sql import types as T

    rows = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]).na.drop()
    picked = rows.orderBy(F.xxhash64(F.lit(seed), *rows.columns), *rows.columns).limit(sample).collect()
    points = np.array([list(r) for r in picked], float).reshape(-1, len(features))
    if not len(points):
        return np.zeros((restarts, 0, len(features))), np.zeros(restarts)
    rnd = np.random.default_rng(seed)
    centres = np.empty((restarts, k, len(features)))
    for r in range(restarts):
        centres[r, 0] = points[rnd.integers(len(points))]
        for j in range(1, k):
            d = ((points[:, None] - centres[r, None, :j]) ** 2).sum(-1).min(1)
            centres[r, j] = points[rnd.choice(len(points), p=d / d.sum())] if d.sum() > 0 else points[rnd.integers(len(points))]
    schema = T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("cost", T.DoubleType()),
                           *[T.StructField(f"s{i}", T.DoubleType()) for i in range(len(features))]])

    def sums(now):
        def run(batches):
            import pandas as pd

            total = np.zeros((restarts * k, 2 + len(features)))
            for pdf in batches:
                x = pdf.to_numpy(float)
                for r in range(restarts):
                    d = ((x[:, None] - now[r][None]) ** 2).sum(-1)
                    near = d.argmin(1)
                    at = r * k + near
                    total[:, 0] += np.bincount(at, minlength=restarts * k)
                    total[:, 1] += np.bincount(at, d[np.arange(len(x)), near], restarts * k)
                    for i in range(x.shape[1]):
                        total[:, 2 + i] += np.bincount(at, x[:, i], restarts * k)
            yield pd.DataFrame({"slot": np.arange(restarts * k, dtype=np.int32), "n": total[:, 0].astype(np.int64), "cost": total[:, 1],
                                **{f"s{i}": total[:, 2 + i] for i in range(total.shape[1] - 2)}})

        got = rows.mapInPandas(run, schema).groupBy("slot").agg(*[F.sum(c).alias(c) for c in schema.names[1:]]).collect()
        out = np.zeros((restarts * k, 2 + now.shape[2]))
        for r in got:
            out[r["slot"]] = list(r)[1:]
        return out.reshape(restarts, k, -1)

    for _ in range(most_steps):
        t = sums(centres)
        n = t[:, :, :1]
        new = np.where(n > 0, t[:, :, 2:] / np.maximum(n, 1), centres)
        moved = np.abs(new - centres).max()
        if moved <= tolerance:
            break
        centres = new
    return centres, sums(centres)[:, :, 1].sum(1)


def kmeans(df: DataFrame, features: Sequence[str], k: int = 4, restarts: int = 20, out: str = "segment", **kw) -> DataFrame:
    """``df`` with the cluster of each row: of all restarts the one with the
    least cost. Rows with a null feature have none. Ties go to the lower number."""
    centres, cost = kmeans_restarts(df, features, k, restarts, **kw)
    best = centres[int(cost.argmin())].tolist()
    if not best:
        return df.withColumn(out, F.lit(None).cast("int"))
    far = [sum(((F.col(c) - v) ** 2 for c, v in zip(features, centre)), F.lit(0.0)) for centre in best]
    least = F.least(*far) if len(far) > 1 else far[0]
    return df.withColumn(out, F.coalesce(*[F.when(d == least, F.lit(i)) for i, d in enumerate(far)]))


def isotonic_calibrated(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str,
                        folds: int = 5, max_iter: int = 10, seed: int = 42) -> DataFrame:
    """Calibrated ensemble: per fold (by a hash of ``key``) a GBT fit on the
    other folds and an isotonic map fit on the held-out fold. The test rows
    get each model's calibrated probability as one more column, and their
    mean; nothing is joined, so null features and equal rows are safe."""
    f = train.withColumn("_fold", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)))
    out = test
    for k in range(folds):
        fit_part, cal_part = f.filter(F.col("_fold") != k), f.filter(F.col("_fold") == k)
        m = fitted(gbt_pipeline(features, label, max_iter=max_iter, max_depth=3), fit_part)
        cal = score(m, cal_part, "_raw")
        iso = IsotonicRegression(featuresCol="_raw", labelCol=label, predictionCol=f"_p{k}").fit(cal)
        out = iso.transform(score(m, out, "_raw")).drop("_raw")
    return out.withColumn("prob", sum(F.col(f"_p{k}") for k in range(folds)) / folds).drop(*[f"_p{k}" for k in range(folds)])


def gain_importance(spark, model: PipelineModel) -> DataFrame:
    """(feature, gain, share, scaled) of a tree pipeline: a row a feature."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = [n.removesuffix("_cat") for n in model.stages[-2].getInputCols()]
    total, top = sum(imp) or 1.0, max(imp) or 1.0
    rows = [(n, float(v), float(v) / total, 100.0 * float(v) / top) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, gain double, share double, scaled double")


#: Least probability, tier and advice, from the top.
TIERS = ((0.5, "High", "Allow extra time and have another flight in mind."),
         (0.3, "Medium", "Watch the status and keep a buffer for connections."),
         (0.0, "Low", "No special care needed."))


def advise(scored: DataFrame, prob: str, factors: dict[str, Column]) -> DataFrame:
    """``scored`` with ``tier`` and ``advice`` by probability, and ``factors``:
    for each name its effect in percent points, to one decimal. Effects stand
    beside each other, each on its own scale; they are no shares."""
    tier, text = F.lit(TIERS[-1][1]), F.lit(TIERS[-1][2])
    for least, name, advice in reversed(TIERS[:-1]):
        tier = F.when(F.col(prob) >= least, name).otherwise(tier)
        text = F.when(F.col(prob) >= least, advice).otherwise(text)
    effects = [x for k, c in factors.items() for x in (F.lit(k), round_to(c, 1))]
    return scored.withColumns({"tier": tier, "advice": text, "factors": F.create_map(*effects)})


#: What a season and a time of day do to a delay.
SEASON_EFFECT, EVENING_EFFECT, MORNING_EFFECT = (1.3, 0.9), 1.35, 0.85


def season_effect(month: Column) -> Column:
    """Percent points of the busy months (December to February, June, July) and of the others."""
    busy, quiet = SEASON_EFFECT
    return F.when(month.isin(12, 1, 2, 6, 7), busy).otherwise(quiet) * 10 - 10


def hour_effect(hour: Column) -> Column:
    """Percent points of the evening (from 18), the morning (to 9) and the rest of the day."""
    return F.when(hour >= 18, EVENING_EFFECT).when(hour <= 9, MORNING_EFFECT).otherwise(1.0) * 10 - 10


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str,
                           key: str, repeats: int = 10, signed: bool = True, seed: int = 42) -> DataFrame:
    """(feature, importance, deviation, repeats): how much AUC falls when a
    feature's values are dealt to other rows, over ``repeats`` deals; with
    ``signed=False`` the size of the change counts.

    A deal gives a row the feature of the row whose rank by key is its own
    rank by a hash of key and repeat. All deals are ranked by one prefix scan
    and met by one join, and all (feature, repeat, row) are scored by one
    transform. Equal keys are ranked in any order.
    """
    base = auc_exact(score(model, df), "prob", label).select("auc").scalar()
    rows = cut_lineage(global_row_number(df.select(key, label, *features), [key], "_rank"))
    n = rows.count()
    deals = rows.select("_rank", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat")) \
        .withColumn("_hash", F.xxhash64("_rank", "_repeat", F.lit(seed)))
    deals = global_row_number(deals, ["_repeat", "_hash", "_rank"], "_place") \
        .select(F.col("_rank").alias("_to"), "_repeat", (F.col("_place") - F.col("_repeat") * n).alias("_from"))
    own = rows.select(F.col("_rank").alias("_to"), label, F.struct(*features).alias("_own"))
    other = rows.select(F.col("_rank").alias("_from"), F.struct(*features).alias("_other"))
    each = deals.join(own, "_to").join(other, "_from") \
        .select("_repeat", label, "_own", "_other", F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    dealt = each.select("feature", "_repeat", label, *[
        F.when(F.col("feature") == f, F.col(f"_other.{f}")).otherwise(F.col(f"_own.{f}")).alias(f) for f in features])
    aucs = auc_exact(score(model, dealt), "prob", label, groups=["feature", "_repeat"])
    fall = base - F.col("auc")
    return aucs.select("feature", (fall if signed else F.abs(fall)).alias("_fall")).groupBy("feature").agg(
        F.avg("_fall").alias("importance"), F.stddev_pop("_fall").alias("deviation"), F.count("_fall").alias("repeats"))


def save_bundle(model: PipelineModel, spark, path: str, features: Sequence[str], version: str) -> None:
    """Model directory plus a one-line JSON metadata table (feature list,
    version), both written through Spark so ``path`` can be shared storage."""
    model.write().overwrite().save(os.path.join(path, "model"))
    meta = json.dumps({"features": list(features), "version": version})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite") \
        .text(os.path.join(path, "metadata"))


def load_bundle(spark, path: str) -> tuple[PipelineModel, dict]:
    meta = json.loads(spark.read.text(os.path.join(path, "metadata")).first()["value"])
    return PipelineModel.load(os.path.join(path, "model")), meta


def train_if_absent(spark, path: str, train, features: Sequence[str], version: str) -> tuple[PipelineModel, dict]:
    """The bundle under ``path``; if there is none of this version, what
    ``train()`` returns is saved first."""
    try:
        model, meta = load_bundle(spark, path)
        if meta["version"] == version:
            return model, meta
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    save_bundle(train(), spark, path, features, version)
    return load_bundle(spark, path)
