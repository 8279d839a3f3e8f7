"""Missing data: where it is, what pattern it follows, and simple ways to fill it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.columns import NUMERIC, nan_to_null
from driftloom.functions.joins import lookup_join
from driftloom.functions.numbering import numbered
from driftloom.operators.ecdf import ROWS_PER_BUCKET, percentiles


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL or NaN."""
    floating = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    return F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()


def missing_percent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, rows, missing, missing_pct) for all columns from one aggregate."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)]
    )
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("missing")) for i, c in enumerate(cols)]
    pct = F.when(F.col("rows") > 0, F.round(F.col("missing") * 100.0 / F.col("rows"), 2)).otherwise(0.0)
    return row.select("rows", F.inline(F.array(*lines))).select(
        "column", "rows", "missing", pct.alias("missing_pct")
    )


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct NULL masks in lexicographic order with their rows, for any number of columns.

    A mask is one string with a character per column, so the order of the strings is the order of the masks.
    """
    cols = list(cols)
    bits = [is_missing(df, c).cast("int").cast("string") for c in cols]
    masks = df.groupBy(F.concat(*bits).alias("__mask")).agg(F.count(F.lit(1)).alias("count"))
    total = df.count()
    names = F.array(*[F.lit(c) for c in cols])

    def at(bit: str) -> Column:
        return F.filter(names, lambda c, i: F.substring("__mask", i + 1, F.lit(1)) == bit)

    return numbered(masks, ["__mask"], "pattern_id", 1).select(
        "pattern_id",
        at("0").alias("observed_columns"),
        at("1").alias("missing_columns"),
        "count",
        F.round(F.col("count") * 100.0 / total, 2).alias("percentage"),
    )


def fill_values(
    df: DataFrame, cols: Sequence[str], strategy: str, constant=None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[str, object]:
    """The fitted fill value of each column: one value per column comes to the driver.

    A column with no value at all gets no fill value (None).
    """
    cols = list(cols)
    numeric = {c: isinstance(df.schema[c].dataType, NUMERIC) for c in cols}
    if strategy == "constant":
        return {c: constant if constant is not None else (0 if numeric[c] else "missing_value") for c in cols}
    if strategy == "mean":
        row = df.agg(*[F.avg(nan_to_null(c)).alias(c) for c in cols]).first()
        return row.asDict()
    if strategy == "median":
        found = percentiles(df, cols, [0.5], rows_per_bucket=rows_per_bucket).collect()
        by_column = {r["column"]: r["quantiles"][0] for r in found}
        return {c: by_column.get(c) for c in cols}
    if strategy == "most_frequent":
        return modes(df, cols)
    raise ValueError(f"unknown strategy {strategy}")


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest on ties, for all columns in one job.

    Values are counted first; then the smallest value per (column, count) and the largest count per column
    are plain aggregates, so no task holds the distinct values of a column.
    """
    kinds = {c: df.schema[c].dataType for c in cols}
    numeric = {c: isinstance(k, NUMERIC) for c, k in kinds.items()}
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (nan_to_null(c) if numeric[c] else F.lit(None).cast("double")).alias("number"),
            (F.lit(None) if numeric[c] else F.col(c)).cast("string").alias("text"),
        )
        for c in cols
    ]
    counted = (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("number").isNotNull() | F.col("text").isNotNull())
        .groupBy("column", "number", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    least = counted.groupBy("column", "n").agg(F.min(F.struct("number", "text")).alias("v"))
    top = {r["column"]: r["v"] for r in least.groupBy("column").agg(F.max_by("v", "n").alias("v")).collect()}
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    best = {}
    for c in cols:
        value = None if c not in top else top[c]["number"] if numeric[c] else top[c]["text"]
        best[c] = int(value) if value is not None and isinstance(kinds[c], whole) else value
    return best


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Put fill values in the place of NULL and NaN. None leaves the column as it is."""
    out = {}
    for c, v in values.items():
        if v is not None:
            x = nan_to_null(c) if isinstance(v, float) else F.when(~is_missing(df, c), F.col(c))
            out[c] = F.coalesce(x, F.lit(v))
    return df.withColumns(out)


def columns_with_missing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    row = df.agg(*[F.max(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"__m{i}"]]


def indicators(df: DataFrame, fitted: Sequence[str], cols: Sequence[str], on_new: str = "error") -> DataFrame:
    """Add <col>_is_na for the columns that had missing values at fit.

    on_new says what happens when another column has missing values now: 'error', 'ignore' or 'add'.
    """
    wanted = list(fitted)
    if on_new != "ignore":
        new = [c for c in columns_with_missing(df, cols) if c not in wanted]
        if new and on_new == "error":
            raise ValueError(f"missing values in {new}, which had none at fit")
        if on_new == "add":
            wanted += new
    return df.withColumns({f"{c}_is_na": is_missing(df, c).cast("int") for c in wanted})


def group_medians(df: DataFrame, group: str, value: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(group, n, median) with exact medians."""
    found = percentiles(df, [value], [0.5], by=[group], rows_per_bucket=rows_per_bucket)
    return found.select(group, "n", F.col("quantiles")[0].alias("median"))


def fill_group_median(
    df: DataFrame, medians: DataFrame, group: str, value: str, known_rows: int | None = None
) -> DataFrame:
    """Fill a missing value with the median of its group. Groups unknown at fit stay missing."""
    joined = lookup_join(df, medians, [group], "n", ["median"], known_rows=known_rows)
    return joined.withColumn(value, F.coalesce(nan_to_null(value), "median")).drop("median")
