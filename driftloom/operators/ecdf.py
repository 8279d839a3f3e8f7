"""Running sums over a global value order, without ever sorting the data in one task.

Everything that needs an empirical distribution (percentiles, two-sample distances, ROC and
precision-recall areas, exact row ranks) goes through the same three steps:

1. rows are counted per distinct value, with map-side combining, so a value that holds a third
   of all rows becomes one row before anything is sorted;
2. values fall into buckets between split points that are fixed literals (the same in every branch
   of the plan and in every retried task), and each bucket is summed;
3. the few bucket sums give each bucket its starting offset, and a window inside
   (group, bucket) does the rest. The join with the offsets and the window share one shuffle.

When the profile finds no more rows than one bucket may hold, there are no split points and no
bucket column, and step 3 is a plain window per group over that bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null

ROWS_PER_BUCKET = 200_000
MAX_BUCKETS = 16_384


# The profile is merged in this many groups of partitions, each of which sends this many points per column.
PROFILE_GROUPS = 64
PROFILE_POINTS = 256


@dataclass(frozen=True)
class Profile:
    """One pass over the data: rows, per column the split points, and any extra counts asked for."""

    rows: int
    splits: dict[str, list[float]]
    extras: dict[str, int]


def profile(
    df: DataFrame,
    cols: Sequence[str],
    extras: Mapping[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Profile:
    """Find split points for all columns, and extra counts, in one aggregate.

    The splits only balance the work; results do not depend on them. Sketches are merged per group of
    partitions, so that no single task takes the sketches of the whole cluster; the driver merges at most
    64 x 256 points per column. The number of buckets grows with the rows, up to twice the shuffle partitions.
    """
    extras = dict(extras or {})
    probs = [(i + 0.5) / PROFILE_POINTS for i in range(PROFILE_POINTS)]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = nan_to_null(c)
        aggs += [F.count(x).alias(f"__n{i}"), F.percentile_approx(x, probs, 4 * PROFILE_POINTS).alias(f"__q{i}")]
    group = (F.spark_partition_id() % PROFILE_GROUPS).alias("__group")
    parts = df.groupBy(group).agg(*aggs, *[e.alias(f"__x_{k}") for k, e in extras.items()]).collect()
    rows = sum(p["__rows"] for p in parts)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    buckets = min(MAX_BUCKETS, max(64, 2 * partitions), max(1, -(-rows // rows_per_bucket)))
    splits = {}
    for i, c in enumerate(cols):
        points = [np.array(p[f"__q{i}"]) for p in parts if p[f"__q{i}"]]
        weights = [np.full(PROFILE_POINTS, p[f"__n{i}"] / PROFILE_POINTS) for p in parts if p[f"__q{i}"]]
        splits[c] = _weighted_splits(points, weights, buckets)
    return Profile(rows, splits, {k: sum(p[f"__x_{k}"] for p in parts) for k in extras})


def _weighted_splits(points: list[np.ndarray], weights: list[np.ndarray], buckets: int) -> list[float]:
    """Distinct numbers that cut the weighted points into about equal parts, interpolated between points."""
    if buckets < 2 or not points:
        return []
    values, weight = np.concatenate(points), np.concatenate(weights)
    finite = np.isfinite(values)
    order = np.argsort(values[finite], kind="stable")
    if not len(order):
        return []
    reached = np.cumsum(weight[finite][order])
    cuts = np.interp(reached[-1] * np.arange(1, buckets) / buckets, reached, values[finite][order])
    return [float(v) for v in np.unique(cuts)]


def long_values(
    df: DataFrame, cols: Sequence[str], splits: Mapping[str, Sequence[float]], keep: Sequence[str | Column] = ()
) -> DataFrame:
    """(keep..., column, bucket, value): one row per non-missing cell; no bucket when nothing is split."""
    carried = [F.col(k) if isinstance(k, str) else k for k in keep]
    kept = df.select(*carried).columns
    wide = df.select(*carried, *[nan_to_null(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    split = [i for i, c in enumerate(cols) if splits.get(c)]
    if split:
        wide = Bucketizer(
            inputCols=[f"__v{i}" for i in split],
            outputCols=[f"__b{i}" for i in split],
            splitsArray=[[float("-inf"), *splits[cols[i]], float("inf")] for i in split],
            handleInvalid="keep",
        ).transform(wide)
    cells = []
    for i, c in enumerate(cols):
        bucket = [(F.col(f"__b{i}").cast("int") if i in split else F.lit(0)).alias("bucket")] if split else []
        cells.append(F.struct(F.lit(c).alias("column"), *bucket, F.col(f"__v{i}").alias("value")))
    long = wide.select(*kept, F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    return long.where(F.col("bucket").isNotNull()) if split else long


def value_counts(
    df: DataFrame,
    cols: Sequence[str],
    splits: Mapping[str, Sequence[float]],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per (by..., column, [bucket,] value) with the given sums of row weights.

    Rows whose group key is NULL are left out, as in a pandas groupby.
    """
    for b in by:
        df = df.where(F.col(b).isNotNull())
    carried = [*by, *[w.alias(name) for name, w in sums.items()]]
    cells = long_values(df, cols, splits, carried)
    bucket = ["bucket"] if "bucket" in cells.columns else []
    return cells.groupBy(*by, "column", *bucket, "value").agg(*[F.sum(s).alias(s) for s in sums])


def prefix_sums(
    counts: DataFrame,
    by: Sequence[str],
    sums: Sequence[str],
    order: str = "value",
) -> DataFrame:
    """Add below_<s> (sum over strictly smaller values in the group), total_<s> and next_value."""
    by = list(by)
    if "bucket" not in counts.columns:
        whole = Window.partitionBy(*by)
        ordered = whole.orderBy(order)
        smaller = ordered.rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(
            *by,
            order,
            *sums,
            *[F.coalesce(F.sum(s).over(smaller), F.lit(0)).alias(f"below_{s}") for s in sums],
            *[F.sum(s).over(whole).alias(f"total_{s}") for s in sums],
            F.lead(order).over(ordered).alias("next_value"),
        )
    offsets = _bucket_offsets(counts, by, sums, order)
    inside = Window.partitionBy(*by, "bucket").orderBy(order)
    inside_before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(offsets, [*by, "bucket"]).select(
        *by,
        order,
        *sums,
        *[(F.col(f"off_{s}") + F.coalesce(F.sum(s).over(inside_before), F.lit(0))).alias(f"below_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
        F.coalesce(F.lead(order).over(inside), F.col("__next_first")).alias("next_value"),
    )


def _bucket_offsets(counts: DataFrame, by: Sequence[str], sums: Sequence[str], order: str) -> DataFrame:
    """(by..., bucket, in_<s>, off_<s>, total_<s>, __next_first): one row per non-empty bucket."""
    totals = counts.groupBy(*by, "bucket").agg(
        *[F.sum(s).alias(f"in_{s}") for s in sums], F.min(order).alias("__first")
    )
    along = Window.partitionBy(*by).orderBy("bucket")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        "bucket",
        F.lead("__first").over(along).alias("__next_first"),
        *[F.col(f"in_{s}") for s in sums],
        *[F.coalesce(F.sum(f"in_{s}").over(before), F.lit(0)).alias(f"off_{s}") for s in sums],
        *[F.sum(f"in_{s}").over(Window.partitionBy(*by)).alias(f"total_{s}") for s in sums],
    )


def percentiles_of_counts(counts: DataFrame, by: Sequence[str], probs: Column, n: str = "n") -> DataFrame:
    """(by..., n, quantiles ARRAY) from value counts. `probs` is an array, which may differ per group.

    The wanted ranks are a small table, two rows per probability and group. Ranks first pick the
    buckets they fall in, so that only those are sorted, and then the values.
    """
    by = list(by)
    total, rank, here = F.col("__total"), F.col("__rank"), F.col(n)
    around = F.transform(probs, lambda p: F.array(F.floor((total - 1) * p), F.ceil((total - 1) * p)))
    ranks = (
        counts.groupBy(*by)
        .agg(F.sum(n).alias("__total"))
        .select(*by, "__total", F.explode(F.array_distinct(F.flatten(around))).alias("__rank"))
    )
    keys = by
    values = counts.select(*by, *[c for c in ("bucket",) if c in counts.columns], "value", n)
    if "bucket" in counts.columns:
        keys = [*by, "bucket"]
        placed = _bucket_offsets(values, by, [n], "value").select(*keys, f"off_{n}", f"in_{n}").join(ranks, by)
        start = F.col(f"off_{n}")
        ranks = placed.where((start <= rank) & (rank < start + F.col(f"in_{n}"))).select(
            *keys, "__total", (rank - start).alias("__local"), "__rank"
        )
        values = values.join(ranks.select(*keys).distinct(), keys, "left_semi")
    else:
        ranks = ranks.withColumn("__local", rank)
    smaller = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    running = values.withColumn("__below", F.coalesce(F.sum(n).over(smaller), F.lit(0)))
    local = F.col("__local")
    hits = running.join(ranks, keys).where((F.col("__below") <= local) & (local < F.col("__below") + here))
    found = hits.groupBy(*by).agg(
        F.max("__total").alias("n"), F.map_from_entries(F.collect_list(F.struct("__rank", "value"))).alias("__at")
    )

    def interpolate(p: Column) -> Column:
        h = (F.col("n") - 1) * p
        low = F.element_at("__at", F.floor(h))
        return low + (F.element_at("__at", F.ceil(h)) - low) * (h - F.floor(h))

    return found.select(*by, "n", F.transform(probs, interpolate).alias("quantiles"))


def percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    splits: Mapping[str, Sequence[float]] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact percentiles (linear rule) of many columns per group: (by..., column, n, quantiles ARRAY)."""
    cols, by = list(cols), list(by)
    if splits is None:
        splits = profile(df, cols, rows_per_bucket=rows_per_bucket).splits
    counts = value_counts(df, cols, splits, {"n": F.lit(1)}, by)
    return percentiles_of_counts(counts, [*by, "column"], F.array(*[F.lit(float(p)) for p in probs]))


def row_ranks(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    out: str = "rank",
    splits: Sequence[float] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exact 0-based position of each row in its group by a unique number; no group is sorted as a whole.

    An empty `by` numbers the whole table.
    """
    if splits is None:
        splits = profile(df, [order], rows_per_bucket=rows_per_bucket).splits[order]
    bounds = [float("-inf"), *splits, float("inf")]
    placed = df.withColumn("__o", nan_to_null(order))
    if splits:
        placed = Bucketizer(inputCol="__o", outputCol="bucket", splits=bounds, handleInvalid="keep").transform(placed)
    else:
        placed = placed.withColumn("bucket", F.lit(0.0))
    return bucketed_ranks(placed, order, by, out).drop("__o")


def bucketed_ranks(placed: DataFrame, order: str | Column, by: Sequence[str], out: str) -> DataFrame:
    """row_ranks for rows that already carry an order-preserving `bucket`."""
    by = list(by)
    totals = placed.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("__in"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(b).alias(f"__k_{b}") for b in by],
        F.col("bucket").alias("__k_bucket"),
        F.coalesce(F.sum("__in").over(before), F.lit(0)).alias("__off"),
    )
    on = [placed[b].eqNullSafe(offsets[f"__k_{b}"]) for b in by] + [placed["bucket"] == offsets["__k_bucket"]]
    inside = Window.partitionBy(*by, "bucket").orderBy(order)
    kept = [c for c in placed.columns if c != "bucket"]
    return placed.join(offsets, on).select(
        *kept, (F.col("__off") + F.row_number().over(inside) - 1).cast("long").alias(out)
    )


def running_max(
    df: DataFrame,
    order: str,
    value: Column,
    by: Sequence[str] = (),
    out: str = "max_before",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add the largest `value` among the rows of the group that come strictly before, by a unique number."""
    by = list(by)
    splits = profile(df, [order], rows_per_bucket=rows_per_bucket).splits[order]
    placed = df.withColumns({"__o": nan_to_null(order), "__v": value})
    kept = df.columns
    if not splits:
        # one bucket: the rows are few enough for a window per group
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return placed.select(*kept, F.max("__v").over(before).alias(out))
    bounds = [float("-inf"), *splits, float("inf")]
    placed = Bucketizer(inputCol="__o", outputCol="bucket", splits=bounds, handleInvalid="keep").transform(placed)
    along = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tops = placed.groupBy(*by, "bucket").agg(F.max("__v").alias("__top"))
    starts = tops.select(
        *[F.col(b).alias(f"__k_{b}") for b in by], F.col("bucket").alias("__k_bucket"), F.max("__top").over(along).alias("__start")
    )
    on = [placed[b].eqNullSafe(starts[f"__k_{b}"]) for b in by] + [placed["bucket"] == starts["__k_bucket"]]
    inside = Window.partitionBy(*by, "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(starts, on).select(*kept, F.greatest("__start", F.max("__v").over(inside)).alias(out))
