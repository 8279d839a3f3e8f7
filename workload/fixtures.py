"""Inputs derived from the given tables by arithmetic that reads the same in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.registry import load

GAPS_SQL = """
gaps AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS x1,
         CASE WHEN o_orderkey % 10 <> 3 THEN c_acctbal END AS x2,
         CAST(c_nationkey AS DOUBLE) AS x3,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with customers, and values missing at random-looking keys."""
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("x1"),
        F.when(k % 10 != 3, F.col("c_acctbal")).alias("x2"),
        F.col("c_nationkey").cast("double").alias("x3"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("priority"),
    )


SCORED_SQL = """
scored AS (
  SELECT l_orderkey, l_linenumber, l_orderkey % 5 AS fold,
         least(CAST(0.999 AS DOUBLE), l_quantity / 51) AS score,
         least(CAST(0.999 AS DOUBLE), l_discount * 10) AS score2,
         least(CAST(0.999 AS DOUBLE), l_tax * 12) AS score3,
         CASE WHEN l_quantity + (l_orderkey * 7919 + l_linenumber * 104729) % 41 - 20 > 25 THEN 1 ELSE 0 END AS label
  FROM lineitem)
"""


def signal_label() -> Column:
    noise = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729) % 41 - 20
    return (F.col("l_quantity") + noise > 25).cast("int")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with three scores and a label that the first score predicts."""
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") % 5).alias("fold"),
        F.least(F.lit(0.999), F.col("l_quantity") / 51).alias("score"),
        F.least(F.lit(0.999), F.col("l_discount") * 10).alias("score2"),
        F.least(F.lit(0.999), F.col("l_tax") * 12).alias("score3"),
        signal_label().alias("label"),
    )


MARKET_SQL = """
market AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus, c_acctbal, c_mktsegment, n_name,
         r_name, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, o_orderkey % 9 + 1 AS family
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)
"""


def market(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with customer, nation and region. Join sides are left to the optimizer's size estimates."""
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            "o_orderkey",
            "o_custkey",
            "o_totalprice",
            "o_orderpriority",
            "o_orderstatus",
            "c_acctbal",
            "c_mktsegment",
            "n_name",
            "r_name",
            (F.col("o_orderstatus") == "F").cast("int").alias("label"),
            (F.col("o_orderkey") % 9 + 1).alias("family"),
        )
    )


def halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Line items shipped before 1998 (reference) and since (current)."""
    items = load(spark, sf, "lineitem")
    return items.where("l_shipdate < timestamp'1998-01-01'"), items.where("l_shipdate >= timestamp'1998-01-01'")
