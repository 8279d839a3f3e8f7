"""What is fitted without a fold, for all folds at once: counts per value and fold, and the total minus the fold's own share.

A statistic of the rows outside fold f needs no scan of its own. Values are counted once per fold; what the others hold is a
subtraction per value, and order statistics, modes, frequencies and encodings follow from those counts. `fit` names the fold that was
left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import col
from driftloom.operators.ecdf import ROWS_PER_BUCKET, percentiles_of_counts, profile, value_counts
from driftloom.operators.encode import as_category, category_sums, m_estimate


def leave_out(counts: DataFrame, keys: Sequence[str], fold: str, folds: int, sums: Sequence[str] = ("n",)) -> DataFrame:
    """(keys..., fit, sums...): for each fold what the other folds hold of a key; keys that no other fold holds are left out.

    counts: one row per key and fold, so a key has at most `folds` rows. The first of `sums` counts rows.
    """
    own = F.map_from_entries(F.collect_list(F.struct(F.col(fold).cast("int"), F.struct(*sums))))
    held = counts.groupBy(*keys).agg(own.alias("__own"), *[F.sum(s).alias(s) for s in sums])
    each = held.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    mine = F.try_element_at("__own", F.col("fit"))
    rest = [(F.col(s) - F.coalesce(mine[s], F.lit(0).cast(held.schema[s].dataType))).alias(s) for s in sums]
    return each.select(*keys, "fit", *rest).where(F.col(sums[0]) > 0)


def leave_out_percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    fold: str,
    folds: int,
    by: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(fit, by..., column, n, quantiles ARRAY): exact percentiles (linear rule) of the rows outside each fold.

    NULL and NaN take no part, nor do rows whose group or fold is NULL. A group that stands in one fold only has no row for it.
    """
    splits = profile(df, cols, rows_per_bucket=rows_per_bucket).splits
    counts = value_counts(df, cols, splits, {"n": F.lit(1)}, [*by, fold])
    keys = [c for c in counts.columns if c not in (fold, "n")]
    return percentiles_of_counts(leave_out(counts, keys, fold, folds), ["fit", *by, "column"], F.array(*[F.lit(float(p)) for p in probs]))


def leave_out_frequencies(df: DataFrame, key: str, fold: str, folds: int) -> DataFrame:
    """(key, fit, n): rows outside each fold that hold a key; NULL keys are not counted."""
    counts = df.where(F.col(key).isNotNull() & F.col(fold).isNotNull()).groupBy(key, fold).agg(F.count(F.lit(1)).alias("n"))
    return leave_out(counts, [key], fold, folds)


def leave_out_modes(df: DataFrame, cols: Sequence[str], fold: str, folds: int) -> DataFrame:
    """(fit, column, mode, n): the most frequent value outside each fold as text, the smallest on ties."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.where(F.col(fold).isNotNull()).select(fold, F.inline(F.array(*cells))).where("value is not null")
    counts = leave_out(long.groupBy("column", "value", fold).agg(F.count(F.lit(1)).alias("n")), ["column", "value"], fold, folds)
    best = counts.groupBy("fit", "column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
    return best.select("fit", "column", F.col("best.value").alias("mode"), (-F.col("best.n")).alias("n"))


def leave_out_categories(df: DataFrame, cols: Sequence[str], fold: str, folds: int) -> DataFrame:
    """(column, category, fit, n): the categories that rows outside each fold have; a missing value is one of its own."""
    cells = [F.struct(F.lit(c).alias("column"), as_category(c).alias("category")) for c in cols]
    long = df.where(F.col(fold).isNotNull()).select(fold, F.inline(F.array(*cells)))
    return leave_out(long.groupBy("column", "category", fold).agg(F.count(F.lit(1)).alias("n")), ["column", "category"], fold, folds)


def nested_encodings(df: DataFrame, cols: Sequence[str], label: Column | str, fold: str, fit: str | None, folds: int, m: float = 10.0) -> DataFrame:
    """(column, category, fit, fold, n, encoding): m-estimates for rows of `fold` when fold `fit` is left out.

    fold = fit: a held-out row, encoded by all rows outside its fold. Otherwise a training row, encoded by the rows outside both
    folds, so its own label does not reach it. fit: a column of df that says for which left-out fold a row was prepared (its
    categories may differ between fits), or None if they don't. Without rows outside, the prior of those rows. All come
    from one sum per category and fold.
    """
    prepared = [fit] if fit else []
    sums = category_sums(df.where(F.col(fold).isNotNull()), cols, label, [*prepared, fold])
    once = sums.where(F.col("column") == cols[0]).groupBy(*prepared, fold).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    pair = F.struct(F.col("n"), F.col("s"))
    by_fold = lambda: F.map_from_entries(F.collect_list(F.struct(F.col(fold).cast("int"), pair))).alias("own")
    # at most `folds` entries of a key
    whole = once.groupBy(*prepared).agg(by_fold(), F.sum("n").alias("n"), F.sum("s").alias("s"))
    each = sums.groupBy("column", "category", *prepared).agg(by_fold(), F.sum("n").alias("n"), F.sum("s").alias("s"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))

    def rest(table: DataFrame) -> DataFrame:
        spread = table if fit else table.withColumn("fit", grid)
        spread = spread.withColumnRenamed(fit, "fit") if fit and fit != "fit" else spread
        spread = spread.withColumn("fold", grid)
        one, two = F.try_element_at("own", F.col("fit")), F.try_element_at("own", F.col("fold"))
        less = lambda c: F.coalesce(one[c], F.lit(0)) + F.when(F.col("fold") != F.col("fit"), F.coalesce(two[c], F.lit(0))).otherwise(0)
        return spread.withColumns({"n": F.col("n") - less("n"), "s": F.col("s") - less("s")}).drop("own")

    priors = rest(whole).select("fit", "fold", (F.col("s") / F.nullif("n", F.lit(0))).alias("prior"))
    # folds x folds rows
    joined = rest(each).join(F.broadcast(priors), ["fit", "fold"])
    value = F.when(F.col("n") > 0, m_estimate(F.col("s"), F.col("n"), F.col("prior"), m)).otherwise(F.col("prior"))
    return joined.select("column", "category", "fit", "fold", "n", value.alias("encoding"), "prior")
