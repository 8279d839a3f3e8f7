"""From probabilities to decisions, batch summaries and recent-score metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import col, nan_to_null
from driftloom.specs import BUFFER_ROWS, RISK_HIGH, RISK_MODERATE


def positive_probability(vector: Column | str = "probability") -> Column:
    """Probability of class 1 from a Spark ML probability vector."""
    return vector_to_array(col(vector))[1]


def risk_band(p: Column | str, high: float = RISK_HIGH, moderate: float = RISK_MODERATE) -> Column:
    """Band of a probability; one that is missing or not a number has no band."""
    p = nan_to_null(p)
    return F.when(p >= high, "High").when(p >= moderate, "Moderate").when(p.isNotNull(), "Low")


def decide(
    scored: DataFrame,
    id_col: str,
    probability: str,
    threshold: float,
    status: tuple[str, str] = ("Survived", "Did Not Survive"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """(id, prediction, probability 4 dp, status, risk_level). Class and band come from the unrounded value.

    A probability that is NULL or not a number is no score: class, probability, status and band are NULL.
    """
    p = nan_to_null(probability)
    hit = p >= threshold
    return scored.select(
        F.col(id_col).cast("long").alias("id"),
        hit.cast("int").alias("prediction"),
        F.round(p, 4).alias("probability"),
        F.when(hit, status[0]).when(~hit, status[1]).alias("status"),
        risk_band(probability).alias("risk_level"),
        *keep,
    )


def batch_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.round(F.avg(F.col("prediction").cast("double")), 4).alias("positive_rate"),
    )


def recent(predictions: DataFrame, order: Sequence[str], n: int = BUFFER_ROWS) -> DataFrame:
    """The last n rows by arrival; a top-n per task first, so nothing is sorted as a whole."""
    return predictions.orderBy(*[F.desc(c) for c in order]).limit(n)


def inference_metrics(
    predictions: DataFrame, order: Sequence[str], threshold: float, n: int = BUFFER_ROWS
) -> DataFrame:
    """One row over the last n predictions, with a status; zeros when there are none."""
    total = predictions.agg(F.count(F.lit(1))).scalar()
    return recent(predictions, order, n).agg(
        F.count(F.lit(1)).alias("current_buffer_size"),
        F.coalesce(F.round(F.avg("probability"), 4), F.lit(0.0)).alias("average_probability"),
        F.coalesce(F.round(F.avg(F.col("prediction").cast("double")), 4), F.lit(0.0)).alias("positive_prediction_rate"),
    ).select(
        total.alias("total_inferences"),
        "current_buffer_size",
        "average_probability",
        "positive_prediction_rate",
        F.lit(float(threshold)).alias("optimal_threshold"),
        F.when(F.col("current_buffer_size") > 0, "HEALTHY_OPERATIONAL").otherwise("AWAITING_INFERENCES").alias("buffer_status"),
    )
