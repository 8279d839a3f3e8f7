import math

import numpy as np
import pytest
from driftloom.functions import columns, tails
from driftloom.functions.joins import lookup_join
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "x,df,p", [(3.841459, 1, 0.05), (36.036, 4, 2.8447e-07), (0.0, 3, 1.0), (18.307, 10, 0.05), (2.0, 2, math.exp(-1))]
)
def test_chi2_tail(x, df, p):
    assert tails.chi2_sf(x, df) == pytest.approx(p, rel=1e-4)


def test_two_sample_tail_counts_all_interleavings():
    from itertools import combinations

    m, n, d = 5, 4, 0.55
    far = 0
    every = list(combinations(range(m + n), m))
    for chosen in every:
        f = g = worst = 0
        for i in range(m + n):
            f, g = (f + 1, g) if i in chosen else (f, g + 1)
            worst = max(worst, abs(f / m - g / n))
        far += worst >= d - 1e-12
    assert tails.two_sample_exact_sf(m, n, d) == pytest.approx(far / len(every), abs=1e-12)


def test_large_sample_tail_agrees_with_the_exact_count():
    exact = tails.two_sample_exact_sf(3000, 2900, 0.03)
    assert tails.kolmogorov_sf(0.03, round(3000 * 2900 / 5900)) == pytest.approx(exact, rel=0.02)


def exact_one_sample_cdf(n, d):
    """Marsaglia, Tsang and Wang (2003)."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    a = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        a[i, 0] -= h ** (i + 1)
        a[m - 1, i] -= h ** (m - i)
    a[m - 1, 0] += (2 * h - 1) ** m if 2 * h - 1 > 0 else 0
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                a[i, j] /= math.factorial(i - j + 1)
    q = np.linalg.matrix_power(a, n)[k - 1, k - 1]
    return q * math.exp(math.lgamma(n + 1) - n * math.log(n))


@pytest.mark.parametrize("n,d", [(100, 0.08), (100, 0.13), (140, 0.1)])
def test_kolmogorov_tail_near_the_exact_value(n, d):
    assert tails.kolmogorov_sf(d, n) == pytest.approx(1 - exact_one_sample_cdf(n, d), abs=1e-3)


def test_cut_matches_interval_rules(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (12.0,), (17.9,), (60.0,), (100.0,), (float("inf"),)], "x double")
    from driftloom.operators import bins

    left = [r[0] for r in df.select(bins.age_bin("x")).collect()]
    assert left == ["Adult", "Adult", "Child", "Teen", "Teen", "Senior", "Adult", "Adult"]
    right = [r[0] for r in df.select(columns.cut("x", [0, 12, 60], ["a", "b"], include_lowest=True, default="?")).collect()]
    assert right == ["?", "?", "a", "a", "b", "b", "?", "?"]


def test_quantile_bins_merge_repeated_edges(spark):
    from driftloom.operators import bins

    df = spark.createDataFrame([(0.0,), (5.0,), (9.0,), (None,)], "x double")
    got = [r[0] for r in df.select(bins.quantile_bin("x", [5.0, 5.0, 8.0])).collect()]
    assert got == ["Q1", "Q1", "Q4", "Q1"]


def test_half_even_ratio(spark):
    from driftloom.operators import parse

    df = spark.createDataFrame([(5.0, 2), (7.0, 2)], "a double, b int")
    assert [r[0] for r in df.select(parse.rounded_ratio("a", "b", 0)).collect()] == [2.0, 4.0]


@pytest.mark.parametrize("known", [None, 10])
def test_lookup_join_with_hot_missing_and_unseen_keys(spark, known):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{i % 4000}")) for i in range(9000)]
    left = spark.createDataFrame(rows, "id long, k string")
    table = left.where("k is not null and k <> 'k17'").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = {r["id"]: r["n"] for r in lookup_join(left, table, ["k"], "n", ["n"], ["id"], known).collect()}
    truth = {}
    for _, k in rows:
        truth[k] = truth.get(k, 0) + 1
    assert len(got) == 9000
    assert all(got[i] == (None if k in (None, "k17") else truth[k]) for i, k in rows)


def test_hot_keys_do_not_meet_in_one_task(spark):
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    table = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(left, table, ["k"], "n", ["n"], ["id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert joined.where("k = -1 and n = 3000").count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", ["missing", "unseen", "known"])
def test_rows_of_a_frequent_key_are_spread_evenly(spark, kind):
    hot = {"missing": F.lit(None).cast("long"), "unseen": F.lit(-5), "known": F.lit(1)}[kind]
    left = spark.range(20_000).select("id", F.when(F.col("id") % 5 < 3, hot).otherwise(F.col("id")).cast("long").alias("k"))
    table = left.where("k is not null and k <> -5").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        joined = lookup_join(left, table, ["k"], "n", ["n"], ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        found = joined.where("n is not null").count()
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / len(sizes)
    assert found == (20_000 if kind == "known" else 8_000)
