"""Fixed and quantile bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import cut
from driftloom.operators.ecdf import ROWS_PER_BUCKET, percentiles
from driftloom.specs import AGE_EDGES, AGE_LABELS, FAMILY_EDGES, FAMILY_LABELS, FARE_LABELS


def age_bin(c: Column | str) -> Column:
    return cut(c, AGE_EDGES, AGE_LABELS, right=False, include_lowest=True, default="Adult")


def family_bin(c: Column | str) -> Column:
    return cut(c, FAMILY_EDGES, FAMILY_LABELS, right=True, include_lowest=True, default="Solo")


def quartiles(df: DataFrame, c: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list[float]:
    """Exact quartiles of one column: three numbers come to the driver."""
    row = percentiles(df, [c], [0.25, 0.5, 0.75], rows_per_bucket=rows_per_bucket).first()
    return list(row["quantiles"]) if row else []


def quantile_bin(
    c: Column | str, inner: Sequence[float], labels: Sequence[str] = FARE_LABELS, low: float = 0.0, default: str = "Q1"
) -> Column:
    """Right-closed bins [low, q1], (q1, q2], ..., (q3, inf)."""
    if not inner:
        return F.lit(default)
    return cut(c, [low, *inner, float("inf")], labels, right=True, include_lowest=True, default=default)
