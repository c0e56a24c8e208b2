"""Searching parameters, and fits along time.

The search is adaptive: a Parzen estimator of the past trials proposes the
next one. Its own state is one row a trial on the driver; fitting and scoring
are Spark jobs, with the folds of a trial side by side.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.metrics import auc_exact
from quarry.operators.models import fitted, gbt_pipeline, score


@dataclass(frozen=True)
class Dimension:
    """A parameter between two bounds, whole or not, on a plain or logarithmic scale."""
    low: float
    high: float
    whole: bool = False
    log: bool = False

    def inner(self, value: float) -> float:
        """0 to 1."""
        lo, hi, v = (math.log(x) if self.log else x for x in (self.low, self.high, value))
        return (v - lo) / (hi - lo) if hi > lo else 0.0

    def outer(self, u: float) -> float:
        u = min(1.0, max(0.0, u))
        if self.whole and not self.log:
            return min(int(self.high), int(self.low) + int(u * (self.high - self.low + 1)))
        v = self.low * (self.high / self.low) ** u if self.log else self.low + u * (self.high - self.low)
        return round(v) if self.whole else v


class ParzenSampler:
    """Proposes points where past good trials are dense and the others are not.

    The first ``startup`` points are random. Then the best ``share`` of the
    trials and the rest each give, for every dimension, a mixture of normal
    kernels around their values and one broad kernel; of ``draws`` points from
    the good mixture the one with the highest ratio of densities is proposed.
    """

    def __init__(self, space: dict[str, Dimension], startup: int = 8, share: float = 0.2, draws: int = 24, seed: int = 42):
        self.space, self.startup, self.share, self.draws = space, startup, share, draws
        self.random = random.Random(seed)
        self.trials: list[tuple[dict, float]] = []

    def propose(self) -> dict:
        if len(self.trials) < self.startup:
            return {k: d.outer(self.random.random()) for k, d in self.space.items()}
        ranked = sorted(self.trials, key=lambda t: -t[1])
        cut = max(2, round(self.share * len(ranked)))
        out = {}
        for k, d in self.space.items():
            good = [d.inner(t[k]) for t, _ in ranked[:cut]]
            rest = [d.inner(t[k]) for t, _ in ranked[cut:]]
            points = [self._draw(good) for _ in range(self.draws)]
            out[k] = d.outer(max(points, key=lambda u: self._log_density(u, good) - self._log_density(u, rest)))
        return out

    def tell(self, params: dict, value: float) -> None:
        """A trial's value; one that could not be scored is the worst."""
        self.trials.append((params, -math.inf if value is None or math.isnan(value) else value))

    @property
    def best(self) -> tuple[dict, float]:
        return max(self.trials, key=lambda t: t[1])

    @staticmethod
    def _width(centres: Sequence[float]) -> float:
        return max(0.05, 0.6 * len(centres) ** -0.4)

    def _draw(self, centres: Sequence[float]) -> float:
        at = self.random.randrange(len(centres) + 1)
        if at == len(centres):
            return self.random.random()
        while True:  # a kernel cut off at the bounds
            u = self.random.gauss(centres[at], self._width(centres))
            if 0.0 <= u <= 1.0:
                return u

    def _log_density(self, u: float, centres: Sequence[float]) -> float:
        w = self._width(centres) if centres else 1.0
        total = 1.0  # the broad kernel
        for c in centres:
            inside = 0.5 * (math.erf((1 - c) / (w * 2 ** 0.5)) + math.erf(c / (w * 2 ** 0.5)))
            total += math.exp(-0.5 * ((u - c) / w) ** 2) / (w * (2 * math.pi) ** 0.5 * inside)
        return math.log(total / (len(centres) + 1))


#: The five parameters of boosted trees and their bounds. Spark's trees have no L2 term; the least gain of a split takes its place.
GBT_SPACE = {"max_iter": Dimension(50, 300, whole=True), "max_depth": Dimension(3, 7, whole=True), "step": Dimension(0.01, 0.15, log=True),
             "min_instances": Dimension(10, 80, whole=True), "min_gain": Dimension(0.0, 0.02)}


def search(space: dict[str, Dimension], objective: Callable[[dict], float], trials: int, startup: int = 8, seed: int = 42) -> ParzenSampler:
    sampler = ParzenSampler(space, startup=startup, seed=seed)
    for _ in range(trials):
        params = sampler.propose()
        sampler.tell(params, objective(params))
    return sampler


def fold_aucs(df: DataFrame, features: Sequence[str], label: str, block: str, folds: int, params: dict, side_by_side: int = 3) -> list[float | None]:
    """AUC of boosted trees with ``params`` on expanding folds: fitted on the
    blocks before ``fold``, scored on block ``fold`` (1 to ``folds``). None
    where a fold's training has one label only or its test has one."""
    def one(k: int) -> float | None:
        train, test = df.where(F.col(block) < k), df.where(F.col(block) == k)
        if train.select(label).distinct().count() < 2:
            return None
        m = fitted(gbt_pipeline(features, label, **params), train)
        r = auc_exact(score(m, test), "prob", label).select("auc").first()
        return r["auc"] if r else None

    with ThreadPoolExecutor(side_by_side) as pool:
        return list(pool.map(one, range(1, folds + 1)))


def param_search(df: DataFrame, features: Sequence[str], label: str, block: str, trials: int, folds: int,
                 space: dict[str, Dimension] = GBT_SPACE, startup: int = 8, seed: int = 42) -> tuple[list[dict], dict]:
    """(a row a trial and fold, best parameters): ``trials`` points of
    ``space``, proposed by ``ParzenSampler`` and valued by the mean AUC over
    the folds that have one."""
    rows: list[dict] = []

    def objective(params):
        aucs = fold_aucs(df, features, label, block, folds, params)
        known = [a for a in aucs if a is not None]
        mean = sum(known) / len(known) if known else float("nan")
        trial = 1 + (rows[-1]["trial"] if rows else 0)
        rows.extend({"trial": trial, "fold": k, "auc": a, "mean_auc": mean, **params} for k, a in enumerate(aucs, 1))
        return mean

    return rows, search(space, objective, trials, startup, seed).best[0]


def walk_forward_fit(df: DataFrame, folds: Sequence[dict], date: str, label: str, fit: Callable[[DataFrame], object],
                     prob: str = "prob", side_by_side: int = 3) -> DataFrame:
    """Every test row of every fold, scored by a model that saw the fold's
    training span alone: ``df``'s columns, ``prob``, ``fold`` and ``fold_auc``.

    ``folds`` are rows with fold, train_start, train_end, test_start and
    test_end (ends exclusive; their number follows the calendar, not the
    rows). ``fit`` takes a span's rows and returns a model. A fold whose
    training has one label only is left out.
    """
    def one(f: dict) -> DataFrame | None:
        train = df.where((F.col(date) >= F.lit(f["train_start"])) & (F.col(date) < F.lit(f["train_end"])))
        if train.select(label).distinct().count() < 2:
            return None
        test = df.where((F.col(date) >= F.lit(f["test_start"])) & (F.col(date) < F.lit(f["test_end"])))
        return score(fit(train), test, prob).withColumn("fold", F.lit(f["fold"]).cast("int"))

    with ThreadPoolExecutor(side_by_side) as pool:
        parts = [x for x in pool.map(one, folds) if x is not None]
    if not parts:
        none = F.lit(None).cast("double")
        return df.limit(0).withColumns({prob: none, "fold": F.lit(None).cast("int"), "fold_auc": none})
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    aucs = auc_exact(out, prob, label, groups=["fold"]).select(F.col("fold").alias("_f"), F.col("auc").alias("fold_auc"))
    return out.join(aucs, F.col("fold") == F.col("_f"), "left").drop("_f")
