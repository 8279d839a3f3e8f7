"""Seeded random search over model families, judged by out-of-fold ROC area."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators.metrics import ranking_metrics
from driftloom.plans.learners import Learner, from_search
from driftloom.plans.oof import PARALLEL_FITS, fold_models, held_out_scores, union
from driftloom.session import durable
from driftloom.specs import SEARCH_SPACES, Space


def draw(space: Space, rng: random.Random):
    if space.choices:
        return rng.choice(space.choices)
    if space.integer:
        step = space.step or 1
        return int(space.low + step * rng.randint(0, int((space.high - space.low) // step)))
    if space.log:
        return math.exp(rng.uniform(math.log(space.low), math.log(space.high)))
    return rng.uniform(space.low, space.high)


def draw_trials(n: int, spaces: Mapping[str, Sequence[Space]] = SEARCH_SPACES, seed: int = 42) -> list[dict]:
    """n draws of a family and its hyper-parameters; the same seed gives the same draws."""
    rng = random.Random(seed)
    families = sorted(spaces)
    trials = []
    for i in range(n):
        family = rng.choice(families)
        trials.append({"trial": i, "family": family, "params": {s.name: draw(s, rng) for s in spaces[family]}})
    return trials


def random_search(
    df: DataFrame,
    label: str,
    fold: str,
    folds: int,
    trials: Sequence[dict],
    to_learner: Callable[[str, Mapping], Learner] = from_search,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """(trial, family, params, pooled_auc, mean_fold_auc), best pooled area first.

    The two areas differ: one ranks all held-out rows together, the other averages the folds. Both come
    from one long table of held-out scores.
    """
    rows = durable(df.select(label, fold, "features"))
    parts = []
    for t in trials:
        learner = to_learner(t["family"], t["params"])
        models = fold_models(rows, lambda: learner.estimator(label=label), fold, folds, parallel)
        parts.append(held_out_scores(rows, models, fold, [label]).withColumn("trial", F.lit(t["trial"])))
    long = durable(union(parts))
    pooled = ranking_metrics(long, label, "p", ["trial"]).select("trial", F.col("auc").alias("pooled_auc"))
    by_fold = ranking_metrics(long, label, "p", ["trial", fold]).groupBy("trial").agg(F.avg("auc").alias("mean_fold_auc"))
    drawn = df.sparkSession.createDataFrame(
        [(t["trial"], t["family"], json.dumps(t["params"], sort_keys=True)) for t in trials],
        "trial int, family string, params string",
    )
    return drawn.join(pooled, "trial").join(by_fold, "trial").orderBy(F.desc("pooled_auc"), "trial")


def best_trial(results: DataFrame) -> dict:
    row = results.first()
    return {"model_name": row["family"], "cv_roc_auc": round(row["pooled_auc"], 6), "hyperparameters": json.loads(row["params"])}
