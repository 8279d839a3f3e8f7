"""Out-of-fold scores: each row is scored by a model that has not seen its fold."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.operators.scoring import positive_probability

PARALLEL_FITS = 4


def fit_parallel(tasks: Sequence[Callable[[], object]], parallel: int = PARALLEL_FITS) -> list:
    """Run independent fits at the same time on one session; results come in task order."""
    if parallel <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(min(parallel, len(tasks))) as pool:
        return pool.map(lambda task: task(), [inherit(t) for t in tasks], chunksize=1)


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def fold_models(
    df: DataFrame, make: Callable[[], Estimator], fold: str, folds: int, parallel: int = PARALLEL_FITS
) -> list[Transformer]:
    """One model per fold, fitted on the other folds. `make` may build a whole pipeline, feature fitting included."""
    return fit_parallel([lambda f=f: make().fit(df.where(F.col(fold) != f)) for f in range(folds)], parallel)


def fitted_fold_scores(
    rows: DataFrame, make: Callable[[], Estimator], folds: int, keep: Sequence[str], out: str = "p", parallel: int = PARALLEL_FITS
) -> DataFrame:
    """(keep..., p) for rows that hold each record once per left-out fold (`fit`, `held`, see FeatureBuilder.fold_features).

    The model of a fold is fitted on the training rows of its fit and scores the held-out ones.
    """
    of = lambda f, held: rows.where((F.col("fit") == f) & (F.col("held") == held))
    models = fit_parallel([lambda f=f: make().fit(of(f, False)) for f in range(folds)], parallel)
    return union([m.transform(of(f, True)).select(*keep, positive_probability().alias(out)) for f, m in enumerate(models)])


def held_out_scores(
    df: DataFrame, models: Sequence[Transformer], fold: str, keep: Sequence[str], out: str = "p"
) -> DataFrame:
    """(keep..., fold, p): the held-out rows of all folds with the score of their fold's model."""
    parts = []
    for f, model in enumerate(models):
        scored = model.transform(df.where(F.col(fold) == f))
        parts.append(scored.select(*keep, fold, positive_probability().alias(out)))
    return union(parts)


def out_of_fold(
    df: DataFrame,
    make: Callable[[], Estimator],
    fold: str,
    folds: int,
    keep: Sequence[str],
    out: str = "p",
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    return held_out_scores(df, fold_models(df, make, fold, folds, parallel), fold, keep, out)


def mean_of_folds(df: DataFrame, models: Sequence[Transformer], keep: Sequence[str], out: str = "p") -> DataFrame:
    """Score new rows with every fold's model and average, as columns of one row."""
    frame = df
    used = []
    for f, model in enumerate(models):
        before = frame.columns
        scored = model.transform(frame)
        frame = scored.select(*before, positive_probability().alias(f"__p{f}"))
        used.append(f"__p{f}")
    total = reduce(lambda a, b: a + b, [F.col(c) for c in used])
    return frame.select(*keep, (total / len(used)).alias(out))
