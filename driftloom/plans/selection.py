"""Recursive feature elimination with cross-validated ROC area."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators.metrics import ranking_metrics
from driftloom.operators.scoring import positive_probability
from driftloom.plans.learners import Learner
from driftloom.plans.oof import PARALLEL_FITS, fit_parallel, union
from driftloom.session import durable


@dataclass(frozen=True)
class Selection:
    """`features`: the chosen ones. `sizes`: (n_features, mean_auc, std_auc). `ranking`: 1 for the chosen, then by order of removal."""

    features: list[str]
    sizes: DataFrame
    ranking: dict[str, int]


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df).select(*keep, "features")


def importances(model: Transformer, widths: Sequence[int] | None = None) -> list[float]:
    """Importance of each feature; that of a vector of `widths` places is the sum over them."""
    found = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    places = [abs(float(v)) for v in found.toArray()]
    if widths is None:
        return places
    ends = list(accumulate(widths))
    return [sum(places[end - n : end]) for n, end in zip(widths, ends, strict=True)]


def vector_widths(df: DataFrame, features: Sequence[str]) -> dict[str, int]:
    """Places of each feature: 1 for a number, those of the first row for a vector."""
    vectors = [c for c in features if isinstance(df.schema[c].dataType, VectorUDT)]
    first = df.select(*vectors).first() if vectors else None
    return {c: len(first[c]) if first and c in vectors else 1 for c in features}


def elimination_path(
    df: DataFrame, features: Sequence[str], learner: Learner, label: str, step: int, least: int
) -> list[tuple[list[str], Transformer]]:
    """(features, model) from all features down to `least`, dropping the `step` weakest each time."""
    left, path, widths = list(features), [], vector_widths(df, features)
    while True:
        model = learner.estimator(label=label).fit(assembled(df, left, [label]))
        path.append((list(left), model))
        if len(left) <= least:
            return path
        weight = dict(zip(left, importances(model, [widths[c] for c in left])))
        drop = min(step, len(left) - least)
        gone = set(sorted(left, key=lambda c: (weight[c], -left.index(c)))[:drop])
        left = [c for c in left if c not in gone]


def select_features(
    df: DataFrame,
    features: Sequence[str],
    learner: Learner,
    label: str,
    fold: str,
    folds: int = 5,
    step: int = 1,
    least: int = 1,
    parallel: int = PARALLEL_FITS,
) -> Selection:
    """Eliminate within each fold, score the held-out rows at every size, and take the best size (the smallest on ties).

    The held-out scores of all folds and sizes are one long table, and one grouped job gives all areas.
    """
    rows = durable(df.select(label, fold, *features))
    tasks = [
        lambda f=f: elimination_path(rows.where(F.col(fold) != f), features, learner, label, step, least)
        for f in range(folds)
    ]
    *paths, whole = fit_parallel([*tasks, lambda: elimination_path(rows, features, learner, label, step, least)], parallel)
    scored = []
    for f, path in enumerate(paths):
        held_out = rows.where(F.col(fold) == f)
        for used, model in path:
            part = model.transform(assembled(held_out, used, [label]))
            scored.append(
                part.select(label, positive_probability().alias("p"), F.lit(len(used)).alias("n_features"), F.lit(f).alias("fold"))
            )
    long = durable(union(scored))
    sizes = durable(
        ranking_metrics(long, label, "p", ["n_features", "fold"])
        .groupBy("n_features")
        .agg(F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"))
    )
    best = sizes.orderBy(F.desc(F.round("mean_auc", 12)), "n_features").first()["n_features"]
    chosen = next(used for used, _ in whole if len(used) == best)
    ranking = {c: 1 for c in chosen}
    after = [used for used, _ in whole if len(used) >= best][::-1]
    for rank, used in enumerate(after[1:], start=2):
        ranking.update({c: rank for c in used if c not in ranking})
    return Selection(chosen, sizes, ranking)
