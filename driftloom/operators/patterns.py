"""Second moments per missing-data pattern: all that EM and chained regressions need from the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null

# The pattern table is brought to the driver only when its moments are at most this many numbers (160 MB).
DRIVER_NUMBERS = 20_000_000


@dataclass(frozen=True)
class Patterns:
    """Per pattern: rows, which columns are missing, column means and centred second moments per row."""

    n: np.ndarray
    missing: np.ndarray
    mean: np.ndarray
    cov: np.ndarray


def pattern_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(mask, n, mean, cov): one aggregate over the data, one row per NULL mask.

    Means and covariances are merged around running means, so large offsets do not cancel digits.
    """
    p = len(cols)
    x = [f"__x{i}" for i in range(p)]
    rows = df.select(*[nan_to_null(c).alias(x[i]) for i, c in enumerate(cols)])
    mask = F.array(*[F.col(c).isNull() for c in x])
    pairs = [F.covar_pop(x[i], x[j]).alias(f"__c{i}_{j}") for i in range(p) for j in range(i, p)]
    found = rows.groupBy(mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"__m{i}") for i, c in enumerate(x)], *pairs
    )
    zero = F.lit(0.0)
    return found.select(
        "mask",
        "n",
        F.array(*[F.coalesce(f"__m{i}", zero) for i in range(p)]).alias("mean"),
        F.array(
            *[F.coalesce(f"__c{min(i, j)}_{max(i, j)}", zero) for i in range(p) for j in range(p)]
        ).alias("cov"),
    )


def unpack(frame, p: int) -> Patterns:
    """Arrays from the pandas form of the pattern table."""
    count = len(frame)
    return Patterns(
        frame["n"].to_numpy(dtype=float),
        np.array([list(m) for m in frame["mask"]], dtype=bool).reshape(count, p),
        np.array([list(m) for m in frame["mean"]], dtype=float).reshape(count, p),
        np.array([list(c) for c in frame["cov"]], dtype=float).reshape(count, p, p),
    )


def fits_driver(table: DataFrame, p: int) -> bool:
    limit = DRIVER_NUMBERS // max(1, p * p + p)
    return table.limit(limit + 1).count() <= limit


def added_up(parts: DataFrame) -> np.ndarray:
    """Sum of the arrays `v` of all tasks. Places are summed in Spark, so one array reaches the driver."""
    cells = parts.select(F.posexplode("v").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x"))
    found = sorted((r["place"], r["x"]) for r in cells.collect())
    return np.array([x for _, x in found])
