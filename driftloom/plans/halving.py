"""Search over boosted models by successive halving: many models are scored in one scan, and few are grown large.

Every rung fits the trials that are left with more trees. The fitted ensembles are data (operators.trees), so the held-out rows are
read once a rung for all trials and folds, and areas for growing numbers of trees come from the same scan: the first trees of
an ensemble are the ensemble that would have been fitted with fewer.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators import trees
from driftloom.operators.metrics import ranking_metrics
from driftloom.plans.learners import Learner, from_search
from driftloom.plans.oof import PARALLEL_FITS, fit_parallel
from driftloom.session import durable


@dataclass(frozen=True)
class Halving:
    """rungs: trees of each rung, growing. keep: share of the trials that goes on from a rung, rounded up. stages: numbers of trees
    of a rung, evenly spaced, whose areas are taken too."""

    rungs: Sequence[int] = (50, 150, 450)
    keep: float = 1 / 3
    stages: int = 5


def stage_counts(trees_: int, stages: int) -> list[int]:
    return sorted({max(1, round(trees_ * (i + 1) / stages)) for i in range(stages)})


def staged_areas(
    rows: DataFrame, learners: Mapping[int, Learner], label: str, fold: str, folds: int, counts: Mapping[int, Sequence[int]], parallel: int = PARALLEL_FITS
) -> DataFrame:
    """(trial, trees, mean_auc, folds): held-out ROC area of each boosted learner at each number of trees, averaged over the folds.

    rows: (label, fold, features), stored. A fold with rows of one class only has no area and counts for nothing. One scan of rows for all.
    """
    tasks = [(t, f) for t in learners for f in range(folds)]
    fit = lambda t, f: learners[t].estimator(label=label).fit(rows.where(F.col(fold) != f))
    fitted = fit_parallel([lambda t=t, f=f: trees.load_forest(trees.node_table(fit(t, f))) for t, f in tasks], parallel)
    forests = dict(zip(tasks, fitted, strict=True))
    models = [[(forests[t, f], counts[t]) for t in learners] for f in range(folds)]
    names = F.array(*[F.struct(F.lit(t).alias("trial"), F.lit(c).alias("trees")) for t in learners for c in counts[t]])
    sums = trees.side_by_side(vector_to_array(F.col("features")), F.col(fold).cast("int"), models)
    scored = durable(rows.select(label, fold, sums.alias("sums")))
    long = scored.select(label, fold, F.posexplode("sums").alias("i", "margin"))
    named = long.select(label, fold, F.get(names, F.col("i")).alias("name"), (1 / (1 + F.exp(-2 * F.col("margin")))).alias("p"))
    areas = ranking_metrics(named.select(label, fold, "name.trial", "name.trees", "p"), label, "p", ["trial", "trees", fold])
    return areas.groupBy("trial", "trees").agg(F.avg("auc").alias("mean_auc"), F.count("auc").alias("folds"))


def successive_halving(
    df: DataFrame,
    label: str,
    fold: str,
    folds: int,
    trials: Sequence[dict],
    how: Halving = Halving(),
    to_learner: Callable[[str, Mapping], Learner] = from_search,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """(rung, trial, family, params, trees, best_trees, mean_auc, survives): what each rung saw.

    mean_auc: the best of the rung's stages, reached first at best_trees. Of n trials of a rung ceil(keep * n) survive: those with the
    largest mean_auc (areas that agree in 12 digits are equal), then the smaller trial; of the last rung one. A trial never
    gets more trees than it asks for. Only boosted learners have stages; others are refused.
    """
    rows = durable(df.select(label, fold, "features"))
    left = {t["trial"]: t for t in trials}
    asked = {n: to_learner(t["family"], t["params"]) for n, t in left.items()}
    if any(learner.family != "gbt" for learner in asked.values()):
        raise ValueError("only boosted learners")
    told = []
    for rung, size in enumerate(how.rungs):
        grown = {}
        for n in left:
            most = min(size, int(asked[n].params.get("maxIter", 20)))
            grown[n] = replace(asked[n], params={**asked[n].params, "maxIter": most})
        counts = {n: stage_counts(learner.params["maxIter"], how.stages) for n, learner in grown.items()}
        # trials x stages rows
        areas = staged_areas(rows, grown, label, fold, folds, counts, parallel).collect()
        best = {}
        for n in left:
            own = [(-round(r["mean_auc"], 12), r["trees"]) for r in areas if r["trial"] == n and r["mean_auc"] is not None]
            best[n] = min(own, default=(0.0, counts[n][-1]))
        kept = 1 if rung == len(how.rungs) - 1 else math.ceil(how.keep * len(left) - 1e-9)
        survivors = sorted(left, key=lambda n: (best[n][0], n))[:kept]
        for n, t in left.items():
            params = json.dumps(t["params"], sort_keys=True)
            told.append((rung, n, t["family"], params, grown[n].params["maxIter"], best[n][1], -best[n][0], n in survivors))
        left = {n: left[n] for n in sorted(survivors)}
    kinds = "rung int, trial int, family string, params string, trees int, best_trees int, mean_auc double, survives boolean"
    return df.sparkSession.createDataFrame(told, kinds)


def winner(results: DataFrame) -> dict:
    """The trial that survives the last rung, with the number of trees that were best for it."""
    row = results.where("survives").orderBy(F.desc("rung")).first()
    params = {**json.loads(row["params"]), "n_estimators": row["best_trees"]}
    return {"model_name": row["family"], "cv_roc_auc": round(row["mean_auc"], 6), "hyperparameters": params}
