"""Name -> (Spark query, SQL text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double, and turn -0.0 into 0.0, so that two engines can be compared by value."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in doubles})
