"""Exact classification metrics as grouped aggregates. `by` gives one result per model or fold."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import bucket_index, nan_to_null, ratio
from driftloom.operators import ecdf

# Threshold grids (start, stop before, step).
WIDE_GRID = (0.1, 0.9, 0.01)
NARROW_GRID = (0.30, 0.70 + 0.01, 0.01)


def grid(start: float, stop: float, step: float) -> list[float]:
    """The grid's own doubles: thresholds are compared with these, never with rounded ones."""
    return [float(t) for t in np.arange(start, stop, step)]


def ranking_metrics(
    scored: DataFrame,
    label: str,
    score: str,
    by: Sequence[str] = (),
    splits: Sequence[float] | None = None,
    rows_per_bucket: int = ecdf.ROWS_PER_BUCKET,
) -> DataFrame:
    """(by..., n_pos, n_neg, auc, pr_auc): ROC area with ties counted half, and average precision.

    Both areas are NULL where a class is absent.
    """
    by = list(by)
    if splits is None:
        splits = ecdf.profile(scored, [score], rows_per_bucket=rows_per_bucket).splits[score]
    y = F.col(label).cast("int")
    counts = ecdf.value_counts(scored, [score], {score: splits}, {"pos": y, "neg": 1 - y}, by)
    table = ecdf.prefix_sums(counts, [*by, "column"], ["pos", "neg"])
    pos, neg = F.col("pos"), F.col("neg")
    tp = F.col("total_pos") - F.col("below_pos")
    fp = F.col("total_neg") - F.col("below_neg")
    summed = table.groupBy(*by, "column").agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(pos * (F.col("below_neg") + neg / 2.0)).alias("__u"),
        F.sum(pos * tp / (tp + fp)).alias("__ap"),
    )
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return summed.select(
        *by,
        "n_pos",
        "n_neg",
        F.when(both, F.col("__u") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"),
        F.when(both, F.col("__ap") / F.col("n_pos")).alias("pr_auc"),
    )


def confusion(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Precision, recall, F1 and accuracy with 0 for empty denominators.

    The macro F1 averages over the classes that occur among labels or predictions.
    """
    f1 = ratio(2.0 * tp, 2 * tp + fp + fn)
    f0 = ratio(2.0 * tn, 2 * tn + fp + fn)
    has1 = (tp + fp + fn > 0).cast("int")
    has0 = (tn + fp + fn > 0).cast("int")
    return {
        "precision": ratio(tp * 1.0, tp + fp),
        "recall": ratio(tp * 1.0, tp + fn),
        "f1_binary": f1,
        "f1_macro": ratio(f1 * has1 + f0 * has0, has1 + has0),
        "accuracy": ratio((tp + tn) * 1.0, tp + fp + fn + tn),
    }


def classification_metrics(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., tp, fp, fn, tn, precision, recall, f1_binary, f1_macro, accuracy) in one aggregate."""
    y, p = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    cells = scored.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    return cells.withColumns(rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def threshold_sweep(
    scored: DataFrame, label: str, score: str, thresholds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """All metrics at every threshold from one pass: (by..., idx, threshold, tp, fp, fn, tn, rates..., youden_j).

    Rows are counted by the number of thresholds at or below their score; a threshold then adds up
    the counts above it. After the first aggregate there are at most len(thresholds)+1 rows per group.
    """
    by = list(by)
    y = F.col(label).cast("int")
    per = (
        scored.select(*by, bucket_index(nan_to_null(score), thresholds).alias("__passed"), y.alias("__y"))
        .groupBy(*by, "__passed")
        .agg(F.sum("__y").alias("pos"), F.sum(1 - F.col("__y")).alias("neg"))
    )
    points = F.array(*[F.lit(float(t)) for t in thresholds])
    slots = F.when(F.col("__passed") > 0, F.sequence(F.lit(0), F.col("__passed") - 1))
    reached = per.select(*by, F.explode(slots).alias("idx"), F.col("pos").alias("tp"), F.col("neg").alias("fp"))
    # every group gets every threshold, also those above its highest score
    zero = F.lit(0)
    totals = per.groupBy(*by).agg(
        F.coalesce(F.sum("pos"), zero).alias("__p"), F.coalesce(F.sum("neg"), zero).alias("__n")
    )
    full = totals.select(*by, "__p", "__n", F.posexplode(points).alias("idx", "threshold"))
    summed = reached.groupBy(*by, "idx").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
    cells = full.join(summed, [*by, "idx"], "left").select(
        *by,
        "idx",
        "threshold",
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("fp", F.lit(0)).alias("fp"),
        (F.col("__p") - F.coalesce("tp", F.lit(0))).alias("fn"),
        (F.col("__n") - F.coalesce("fp", F.lit(0))).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    youden = ratio(tp * 1.0, tp + fn) - ratio(fp * 1.0, fp + tn)
    return cells.withColumns({**rates(tp, fp, fn, tn), "youden_j": youden})


def with_cost(sweep: DataFrame, false_positive: float, false_negative: float) -> DataFrame:
    """Add the total cost of the wrong decisions at each threshold."""
    return sweep.withColumn("cost", F.col("fp") * false_positive + F.col("fn") * false_negative)


def best_threshold(sweep: DataFrame, metric: str = "f1_macro", by: Sequence[str] = (), least: bool = False) -> DataFrame:
    """The sweep row with the best metric per group, the lowest threshold on ties."""
    by = list(by)
    # metrics are compared after rounding, so that equal values written differently stay ties
    value = F.round(metric, 5) if not least else -F.col(metric)
    kept = [c for c in sweep.columns if c not in by]
    best = F.max_by(F.struct(*kept), F.struct(value, -F.col("idx"))).alias("__best")
    return sweep.groupBy(*by).agg(best).select(*by, "__best.*")


def cross_validated_threshold(
    scored: DataFrame, label: str, score: str, fold: str, metric: str = "f1_macro", thresholds: Sequence[float] | None = None
) -> DataFrame:
    """One row: mean and deviation of the folds' best thresholds, and the mean fold AUC."""
    points = list(thresholds) if thresholds is not None else grid(*NARROW_GRID)
    best = best_threshold(threshold_sweep(scored, label, score, points, [fold]), metric, [fold])
    areas = ranking_metrics(scored, label, score, [fold])
    chosen = F.round("threshold", 3)
    return best.join(areas, fold).agg(
        F.round(F.avg(chosen), 3).alias("mean_optimal_threshold"),
        F.round(F.stddev_pop(chosen), 4).alias("std_threshold"),
        F.round(F.avg("auc"), 6).alias("mean_cv_auc"),
        F.count(F.lit(1)).alias("folds"),
    )


def brier(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    gap = nan_to_null(score) - F.col(label).cast("double")
    return scored.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def reliability(scored: DataFrame, label: str, score: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Per probability bin: rows, mean score and positive share."""
    inner = [i / bins for i in range(1, bins)]
    return (
        scored.withColumn("bin", bucket_index(nan_to_null(score), inner))
        .groupBy(*by, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(nan_to_null(score)).alias("mean_score"),
            F.avg(F.col(label).cast("double")).alias("positive_rate"),
        )
    )
