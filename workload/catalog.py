"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.operators import encode, metrics
from workload import evaluation, facts, foldfits, imputation, models, streams, tabular  # noqa: F401
from workload.registry import ORACLES, QUERIES, load


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("int").alias("label")
    )
    table = encode.target_encoding(orders, ["o_orderpriority"], "label")
    prior = orders.agg(F.avg(F.col("label").cast("double"))).scalar()
    scored = encode.apply_target_encoding(orders, table, ["o_orderpriority"], prior, spread_by=["o_orderkey"])
    return metrics.ranking_metrics(scored, "label", "o_orderpriority_TE")
