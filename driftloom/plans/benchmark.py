"""Comparison of several models on the same folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators.metrics import classification_metrics, ranking_metrics
from driftloom.operators.scoring import positive_probability
from driftloom.plans.oof import PARALLEL_FITS, fit_parallel, fold_models, held_out_scores, union
from driftloom.session import durable


def score_table(
    df: DataFrame,
    candidates: Mapping[str, Callable[[], Estimator]],
    id_col: str,
    label: str,
    fold: str,
    folds: int,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    """(algorithm, part, id, label, p) for the out-of-fold and the training scores of every candidate."""
    parts = []
    for name, make in candidates.items():
        models = fold_models(df, make, fold, folds, parallel)
        held_out = held_out_scores(df, models, fold, [id_col, label]).drop(fold)
        parts.append(held_out.withColumns({"algorithm": F.lit(name), "part": F.lit("cv")}))
    names = list(candidates)
    fitted = fit_parallel([lambda n=n: candidates[n]().fit(df) for n in names], parallel)
    for name, model in zip(names, fitted):
        trained = model.transform(df).select(id_col, label, positive_probability().alias("p"))
        parts.append(trained.withColumns({"algorithm": F.lit(name), "part": F.lit("train")}))
    return union(parts)


def benchmark_table(scores: DataFrame, label: str) -> DataFrame:
    """(algorithm, cv_accuracy, cv_f1_macro, cv_roc_auc, train_accuracy, train_roc_auc) in percent, best area first.

    All models are measured together: one grouped job for the areas, one for the counts.
    """
    by = ["algorithm", "part"]
    areas = ranking_metrics(scores, label, "p", by)
    decided = scores.withColumn("prediction", (F.col("p") >= 0.5).cast("int"))
    counts = classification_metrics(decided, label, "prediction", by)
    both = areas.join(counts, by)

    def pick(part: str, metric: str):
        return F.round(F.max(F.when(F.col("part") == part, F.col(metric))) * 100, 2)

    return (
        both.groupBy("algorithm")
        .agg(
            pick("cv", "accuracy").alias("cv_accuracy"),
            pick("cv", "f1_macro").alias("cv_f1_macro"),
            pick("cv", "auc").alias("cv_roc_auc"),
            pick("train", "accuracy").alias("train_accuracy"),
            pick("train", "auc").alias("train_roc_auc"),
        )
        .orderBy(F.desc("cv_roc_auc"), "algorithm")
    )


def run_benchmark(
    df: DataFrame,
    candidates: Mapping[str, Callable[[], Estimator]],
    id_col: str,
    label: str,
    fold: str,
    folds: int,
    parallel: int = PARALLEL_FITS,
) -> DataFrame:
    return benchmark_table(durable(score_table(durable(df), candidates, id_col, label, fold, folds, parallel)), label)


def winner(table: DataFrame) -> str:
    return table.first()["algorithm"]
