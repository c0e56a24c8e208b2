"""Exact model-evaluation metrics over (score, label) columns.

Ranking metrics aggregate to one row per distinct score first (counts of
positives and negatives), then use the distributed prefix scan; no step
orders raw rows globally and no group is collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import safe_divide
from quarry.session import cut_lineage
from quarry.operators.ordered import global_row_number, group_offsets, ordered_scan


def _score_counts(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
              .groupBy(*groups, score)
              .agg(F.sum(F.col(label).cast("long")).alias("_pos"),
                   F.sum((1 - F.col(label)).cast("long")).alias("_neg")))


def auc_exact(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with tied scores counted as 1/2 (Mann-Whitney), per group.

    AUC = sum_s pos(s) * (neg(< s) + neg(s) / 2) / (P * N). neg(< s) is a
    prefix sum over (group, score); the per-group offset is the running
    total at the group's first score.
    """
    g = list(groups) or ["_g"]
    base = df if groups else df.withColumn("_g", F.lit(0))
    cnt = cut_lineage(_score_counts(base, score, label, g))  # read twice
    sc = ordered_scan(cnt, g + [score], {"_cn": ("sum", "_neg")})
    sc = sc.withColumn("_before", F.col("_cn") - F.col("_neg"))
    start = group_offsets(cnt, g, {"_b0": "_neg"}).select(*g, "_b0")
    j = sc.join(start, g)
    below = F.col("_before") - F.col("_b0")
    r = j.groupBy(*g).agg((F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0))
                           / (F.sum("_pos") * F.sum("_neg"))).alias("auc"),
                          F.sum(F.col("_pos") + F.col("_neg")).alias("n"))
    return r if groups else r.drop("_g")


def confusion(df: DataFrame, prob: str, label: str, threshold: float = 0.5,
              groups: Sequence[str] = ()) -> DataFrame:
    pred = F.col(prob) >= threshold
    y = F.col(label) == 1
    c = df.groupBy(*groups).agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
                                F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))
    prec = safe_divide("tp", F.col("tp") + F.col("fp"), 0.0)
    rec = safe_divide("tp", F.col("tp") + F.col("fn"), 0.0)
    return c.select(*groups, "tp", "fp", "fn", "tn",
                    ((F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
                    .alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    safe_divide(2 * prec * rec, prec + rec, 0.0).alias("f1"))


def logloss_brier(df: DataFrame, prob: str, label: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label)
    return df.agg(F.avg(-(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"),
                  F.avg((F.col(prob) - y) ** 2).alias("brier"), F.count(F.lit(1)).alias("n"))


def roc_pr_points(df: DataFrame, score: str, label: str, max_points: int = 50) -> DataFrame:
    """ROC / PR curve at every distinct score (descending), thinned to about
    ``max_points`` by keeping every k-th point and the last one."""
    cnt = _score_counts(df, score, label)
    sc = ordered_scan(cnt, [(score, False)], {"tp": ("sum", "_pos"), "fp": ("sum", "_neg")})
    sc = global_row_number(sc, [(score, False)], "_i")
    tot = cnt.agg(F.sum("_pos").alias("P"), F.sum("_neg").alias("N"), F.count(F.lit(1)).alias("K"))
    P, N, K = tot.select("P").scalar(), tot.select("N").scalar(), tot.select("K").scalar()
    step = F.greatest(F.ceil(K / F.lit(float(max_points))), F.lit(1))
    keep = (((F.col("_i") - 1) % step) == 0) | (F.col("_i") == K)
    return sc.filter(keep).select(F.col(score).alias("threshold"), "tp", "fp",
                                  (F.col("tp") / P).alias("tpr"), (F.col("fp") / N).alias("fpr"),
                                  (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def threshold_sweep(df: DataFrame, prob: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Precision / recall / F1 per threshold from one pass of conditional
    counts (no per-threshold copy of the data)."""
    y = F.col(label) == 1
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(prob) >= t
        aggs += [F.count_if(pred & y).alias(f"tp{i}"), F.count_if(pred & ~y).alias(f"fp{i}"),
                 F.count_if(~pred & y).alias(f"fn{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"),
                              F.col(f"fp{i}").alias("fp"), F.col(f"fn{i}").alias("fn"))
                     for i, t in enumerate(thresholds)])
    long = wide.select(F.inline(rows))
    prec = safe_divide("tp", F.col("tp") + F.col("fp"), 0.0)
    rec = safe_divide("tp", F.col("tp") + F.col("fn"), 0.0)
    return long.select("threshold", "tp", "fp", "fn", prec.alias("precision"), rec.alias("recall"),
                       safe_divide(2 * prec * rec, prec + rec, 0.0).alias("f1"))


def split_hash(id_col: str) -> F.Column:
    """Portable 32-bit multiplicative hash of an integer id (same value in
    any SQL engine with 64-bit integers)."""
    return F.pmod((F.pmod(F.col(id_col), F.lit(1000003)) * F.lit(2654435761)), F.lit(4294967296))


def stratified_split(df: DataFrame, id_col: str, label: str, train_frac: float = 0.8) -> DataFrame:
    """Exact stratified split: within each label the first floor(n * frac)
    rows in hash order are train. Ranks come from the prefix scan over
    (label, hash, id), so a dominant label is still ranked in parallel."""
    d = df.withColumn("_h", split_hash(id_col))
    r = global_row_number(d, [label, "_h", id_col], "_r")
    per = r.groupBy(label).agg(F.min("_r").alias("_r0"), F.count(F.lit(1)).alias("_n"))
    j = r.join(per, label)
    pos = F.col("_r") - F.col("_r0") + 1
    return j.withColumn("split", F.when(pos <= F.floor(F.col("_n") * train_frac), "train").otherwise("test")) \
            .drop("_h", "_r", "_r0", "_n")
