"""Promotion rule and quality gate over plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null
from driftloom.operators.ecdf import ROWS_PER_BUCKET, running_max
from driftloom.specs import GATE_LIMITS, PROMOTION_AUC


def promotion_history(
    registry: DataFrame,
    version: str = "version",
    auc: str = "auc",
    model: str | None = None,
    least: float = PROMOTION_AUC,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """What each registered version became when it was registered.

    A version is promoted when its AUC reaches the limit and beats the champion of its time. The
    champion is the running maximum of the qualified versions before it, so the whole history is
    one running maximum of (auc, -version). A version without a metric counts as 0.
    """
    score = F.coalesce(nan_to_null(auc), F.lit(0.0))
    qualified = score >= least
    entry = F.when(qualified, F.struct(score.alias("auc"), (-F.col(version)).alias("age")))
    marked = running_max(registry, version, entry, [model] if model else [], "__champion", rows_per_bucket)
    before, before_auc = -F.col("__champion.age"), F.col("__champion.auc")
    promoted = qualified & (before_auc.isNull() | (score > before_auc))
    return marked.withColumns(
        {
            "is_champion": promoted,
            "status": F.when(promoted, "promoted_to_champion").otherwise("registered_as_challenger"),
            "previous_champion": F.when(promoted, before),
            "champion_now": F.when(promoted, F.col(version)).otherwise(before),
            "champion_auc": F.when(promoted, score).otherwise(F.coalesce(before_auc, F.lit(0.0))),
        }
    ).drop("__champion")


def aliases(history: DataFrame, version: str = "version", model: str | None = None) -> DataFrame:
    """Who holds each alias at the end: champion, previous_champion, challenger."""
    keys = [model] if model else []
    promoted = F.when(F.col("is_champion"), F.col(version))
    return history.groupBy(*keys).agg(
        F.max(promoted).alias("champion"),
        F.max_by("previous_champion", promoted).alias("previous_champion"),
        F.max(F.when(~F.col("is_champion"), F.col(version))).alias("challenger"),
    )


def quality_gate(metrics: DataFrame, limits: Sequence[tuple[str, str, float]] = GATE_LIMITS) -> DataFrame:
    """(metric, op, limit, actual, passed) from a (metric, value) table. A metric that is not there fails."""
    wanted = metrics.sparkSession.createDataFrame(list(limits), "metric string, op string, `limit` double")
    value, limit = F.col("value"), F.col("limit")
    # the limits are a literal handful of rows
    joined = F.broadcast(wanted).join(metrics, "metric", "left")
    passed = F.when(F.col("op") == ">=", value >= limit).when(F.col("op") == "<=", value <= limit)
    return joined.select(
        "metric", "op", "limit", F.round("value", 4).alias("actual"), F.coalesce(passed, F.lit(False)).alias("passed")
    )


def gate_status(checks: DataFrame) -> DataFrame:
    """One row: PASSED only if every check has passed."""
    return checks.agg(
        F.when(F.bool_and("passed"), "PASSED").otherwise("FAILED").alias("status"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def gate_report(checks: DataFrame) -> DataFrame:
    """The checks with the time they were made, for a report sink."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return checks.withColumn("timestamp", stamp)
