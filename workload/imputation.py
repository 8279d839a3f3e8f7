"""Queries: nearest neighbours, Little's test, chained regressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftloom.operators import knn, mcar, mice
from workload.fixtures import gaps
from workload.registry import load, query, r6


@query(
    """WITH p AS (SELECT p_partkey, p_retailprice, CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_size AS DOUBLE) END AS s FROM part),
    d AS (SELECT r.p_partkey, q.s, sqrt((r.p_retailprice - q.p_retailprice) * (r.p_retailprice - q.p_retailprice) * 2.0) AS d,
            row_number() OVER (PARTITION BY r.p_partkey ORDER BY
              sqrt((r.p_retailprice - q.p_retailprice) * (r.p_retailprice - q.p_retailprice) * 2.0), q.p_partkey) AS k
          FROM p r JOIN p q ON r.s IS NULL AND q.s IS NOT NULL),
    e AS (SELECT p_partkey, CASE WHEN min(d) = 0 THEN avg(s) FILTER (d = 0)
            ELSE sum(s / nullif(d, 0)) / sum(1 / nullif(d, 0)) END AS e FROM d WHERE k <= 5 GROUP BY 1)
    SELECT p.p_partkey, p.p_retailprice, round(coalesce(p.s, e.e), 6) AS p_size FROM p LEFT JOIN e USING (p_partkey)"""
)
def knn_impute(spark, sf):
    parts = load(spark, sf, "part").select(
        "p_partkey",
        "p_retailprice",
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_size").cast("double")).alias("p_size"),
    )
    return r6(knn.knn_fill(parts, parts, ["p_retailprice", "p_size"], "p_partkey", 5))


@query()
def mcar_test(spark, sf):
    return mcar.littles_test(gaps(spark, sf), ["x1", "x2", "x3"]).frame(spark)


@query()
def mice_impute(spark, sf):
    df = gaps(spark, sf).select("o_orderkey", "x1", "x2", "x3")
    chain = mice.fit_chain(df, ["x1", "x2", "x3"])
    return r6(mice.apply_chain(df, chain), 4)
