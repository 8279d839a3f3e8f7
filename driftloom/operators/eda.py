"""Descriptive aggregates and report tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import bucket_index, col, lookup, nan_to_null
from driftloom.functions.joins import lookup_join, row_bound
from driftloom.operators.ecdf import ROWS_PER_BUCKET, percentiles
from driftloom.session import durable


def kpis(df: DataFrame, label: str, mean_col: str, money_col: str) -> DataFrame:
    """One row: rows, positives, negatives, positive rate %, mean, mean and exact median of the money column."""
    y = F.col(label).cast("double")
    median = percentiles(df, [money_col], [0.5]).select(F.col("quantiles")[0]).scalar()
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(y).cast("long").alias("positives"),
        F.round(F.avg(y) * 100, 2).alias("positive_rate"),
        F.round(F.avg(nan_to_null(mean_col)), 1).alias(f"avg_{mean_col}"),
        F.round(F.avg(nan_to_null(money_col)), 2).alias(f"avg_{money_col}"),
    )
    return row.withColumns(
        {"negatives": F.col("total") - F.col("positives"), f"median_{money_col}": F.round(median, 2)}
    )


def group_rate(df: DataFrame, keys: Sequence[str], label: str, means: Sequence[str] = ()) -> DataFrame:
    """Per group: non-missing labels, positive rate in percent (one decimal), means (two decimals)."""
    return df.groupBy(*keys).agg(
        F.count(label).alias("total"),
        F.round(F.avg(F.col(label).cast("double")) * 100, 1).alias("rate_pct"),
        *[F.round(F.avg(nan_to_null(c)), 2).alias(f"avg_{c}") for c in means],
    )


def named(c: Column | str, names: Mapping, default: str = "Unknown") -> Column:
    """Code to name; unmapped and missing codes get the default."""
    return lookup(c, names, default)


def group_by_bins(
    df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str], label: str
) -> DataFrame:
    """Per bin (a, b]: rows and positive rate, with empty bins kept and out-of-range rows left out."""
    x = nan_to_null(value)
    slot = F.when((x > float(edges[0])) & (x <= float(edges[-1])), bucket_index(x, edges[1:-1], closed="right"))
    counted = (
        df.select(slot.alias("__slot"), F.col(label).cast("double").alias("__y"))
        .where(F.col("__slot").isNotNull())
        .groupBy("__slot")
        .agg(F.count(F.lit(1)).alias("__n"), F.avg("__y").alias("__m"))
    )
    bins = df.sparkSession.createDataFrame(list(enumerate(labels)), "__slot int, bin string")
    return bins.join(F.broadcast(counted), "__slot", "left").select(
        "bin", F.coalesce("__n", F.lit(0)).alias("total"), F.round(F.col("__m") * 100, 1).alias("rate_pct")
    )


def correlations(df: DataFrame, cols: Sequence[str], lower_only: bool = False) -> DataFrame:
    """(col_a, col_b, corr): pairwise complete Pearson correlations, all pairs in one aggregate."""
    pairs = list(combinations(range(len(cols)), 2))
    clean = df.select(*[nan_to_null(c).alias(f"__c{i}") for i, c in enumerate(cols)])
    row = clean.agg(
        *[F.corr(f"__c{i}", f"__c{j}").alias(f"__r{i}_{j}") for i, j in pairs],
        *[F.corr(f"__c{i}", f"__c{i}").alias(f"__r{i}_{i}") for i in range(len(cols))],
    )
    cells = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if j < i or not lower_only]
    lines = [
        F.struct(
            F.lit(cols[i]).alias("col_a"),
            F.lit(cols[j]).alias("col_b"),
            F.col(f"__r{min(i, j)}_{max(i, j)}").alias("corr"),
        )
        for i, j in cells
    ]
    return row.select(F.inline(F.array(*lines)))


def box_stats(
    df: DataFrame, value: str, group: str, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Per group: quartiles and the outermost values within 1.5 IQR of them."""
    quartiles = percentiles(df, [value], [0.25, 0.5, 0.75], by=[group], rows_per_bucket=rows_per_bucket)
    fitted = durable(
        quartiles.select(group, "n", *[F.col("quantiles")[i].alias(q) for i, q in enumerate(("q1", "median", "q3"))])
    )
    x, q1, q3 = nan_to_null(value), F.col("q1"), F.col("q3")
    reach = (q3 - q1) * 1.5
    rows = df.where(F.col(group).isNotNull()).select(group, x.alias(value))
    return (
        lookup_join(rows, fitted, [group], "n", ["q1", "median", "q3"], known_rows=row_bound(fitted))
        .groupBy(group)
        .agg(
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(F.col(value) >= q1 - reach, F.col(value))).alias("__low"),
            F.max(F.when(F.col(value) <= q3 + reach, F.col(value))).alias("__high"),
        )
        .select(
            group,
            "q1",
            "median",
            "q3",
            F.least("__low", "q1").alias("whisker_low"),
            F.greatest("__high", "q3").alias("whisker_high"),
        )
    )


def cohorts(df: DataFrame, definitions: Mapping[str, Column], label: str, levels: Sequence[tuple[float, str]]) -> DataFrame:
    """Rows, positive rate and level of overlapping named cohorts, in one pass.

    `levels` is (least rate in percent, name) from high to low.
    """
    row = df.agg(
        *[
            agg
            for i, cond in enumerate(definitions.values())
            for agg in (
                F.count_if(cond).alias(f"__n{i}"),
                F.avg(F.when(cond, F.col(label).cast("double"))).alias(f"__m{i}"),
            )
        ]
    )
    lines = [
        F.struct(F.lit(name).alias("cohort"), F.col(f"__n{i}").alias("n"), F.round(F.col(f"__m{i}") * 100, 1).alias("rate_pct"))
        for i, name in enumerate(definitions)
    ]
    rate = F.col("rate_pct")
    level = F.lit(levels[-1][1])
    for least, name in reversed(levels[:-1]):
        level = F.when(rate >= least, F.lit(name)).otherwise(level)
    return row.select(F.inline(F.array(*lines))).withColumn("level", level)


def marginals(df: DataFrame, dims: Sequence[str], label: str, kind: str = "sets") -> DataFrame:
    """Counts and rates per single dimension ('sets'), per 'rollup' or per 'cube' of them, in one pass."""
    y = F.col(label).cast("double")
    aggs = [
        F.grouping_id().cast("long").alias("grouping"),
        F.count(F.lit(1)).alias("n"),
        F.avg(y).alias("rate"),
    ]
    columns = [F.col(d) for d in dims]
    if kind == "rollup":
        return df.rollup(*columns).agg(*aggs)
    if kind == "cube":
        return df.cube(*columns).agg(*aggs)
    return df.groupingSets([[c] for c in columns], *columns).agg(*aggs)


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows per value, a missing value being a value of its own."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "metric", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), variable, value)


def top(df: DataFrame, score: str, tie: str, k: int) -> DataFrame:
    """The k best rows by score, ties by key."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(k)


def moments(df: DataFrame, c: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation."""
    return df.groupBy(*by).agg(F.avg(col(c)).alias("mean"), F.stddev_pop(col(c)).alias("std"))


def latency_summary(df: DataFrame, ms: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mean and exact 95th and 99th percentile (linear rule) of a latency log."""
    tails = percentiles(df, [ms], [0.95, 0.99], by=by, rows_per_bucket=rows_per_bucket)
    tails = tails.select(*by, F.col("quantiles")[0].alias("p95_ms"), F.col("quantiles")[1].alias("p99_ms"))
    x = nan_to_null(ms)
    if not by:
        both = tails.select(F.struct("p95_ms", "p99_ms")).scalar()
        return df.agg(F.count(x).alias("n"), F.avg(x).alias("mean_ms")).select("n", "mean_ms", both["p95_ms"].alias("p95_ms"), both["p99_ms"].alias("p99_ms"))
    return df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean_ms")).join(tails, list(by))
