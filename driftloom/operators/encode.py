"""Frequency, target and one-hot encoding, and column alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.functions.columns import col
from driftloom.functions.joins import lookup_join
from driftloom.functions.numbering import numbered
from driftloom.session import durable

MISSING = "nan"


def as_category(c: Column | str) -> Column:
    """Text form of a value; a missing value is a category of its own."""
    return F.coalesce(col(c).cast("string"), F.lit(MISSING))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(key, n) over the non-missing keys."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def frequency_encode(
    df: DataFrame,
    counts: DataFrame,
    key: str,
    out: str,
    unseen: int = 1,
    spread_by: Sequence[str] | None = None,
    known_rows: int | None = None,
) -> DataFrame:
    """Add the number of fit rows that share the key; `unseen` for keys not known at fit."""
    joined = lookup_join(df, counts, [key], "n", ["n"], spread_by, known_rows)
    return joined.withColumn(out, F.coalesce("n", F.lit(unseen)).cast("long")).drop("n")


def category_sums(df: DataFrame, cols: Sequence[str], label: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """(column, category, by..., n, s): rows and label sum for all columns from one aggregate."""
    y = col(label).cast("double")
    cells = [F.struct(F.lit(c).alias("column"), as_category(c).alias("category")) for c in cols]
    long = df.select(*by, y.alias("__y"), F.inline(F.array(*cells)))
    return long.groupBy("column", "category", *by).agg(F.count("__y").alias("n"), F.sum("__y").alias("s"))


def _of_first(sums: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The sums of one column, which cover every row once. Zeroed and not filtered, so the same shuffle serves again."""
    mine = F.col("column") == cols[0]
    return sums.withColumns({"n": F.when(mine, F.col("n")).otherwise(0), "s": F.when(mine, F.col("s")).otherwise(0.0)})


def m_estimate(s: Column, n: Column, prior: Column, m: float) -> Column:
    return (s + prior * m) / (n + m)


def target_encoding(df: DataFrame, cols: Sequence[str], label: Column | str, m: float = 10.0) -> DataFrame:
    """(column, category, n, encoding, prior): the m-estimate of every category."""
    sums = category_sums(df, cols, label)
    prior = _of_first(sums, cols).agg(F.sum("s") / F.sum("n")).scalar()
    return sums.select("column", "category", "n", m_estimate(F.col("s"), F.col("n"), prior, m).alias("encoding"))


def apply_target_encoding(
    df: DataFrame,
    table: DataFrame,
    cols: Sequence[str],
    prior: Column | float,
    suffix: str = "_TE",
    spread_by: Sequence[str] | None = None,
    known_rows: int | None = None,
) -> DataFrame:
    """Add <col>_TE; unseen categories, and columns the table does not know, get the prior."""
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(f"{c}{suffix}", prior)
            continue
        one = table.where(F.col("column") == c).select(F.col("category").alias("__category"), "n", "encoding")
        keyed = df.withColumn("__category", as_category(c))
        joined = lookup_join(keyed, one, ["__category"], "n", ["encoding"], spread_by, known_rows)
        df = joined.withColumn(f"{c}{suffix}", F.coalesce("encoding", prior)).drop("encoding", "__category")
    return df


def fold_encoding(df: DataFrame, cols: Sequence[str], label: Column | str, fold: str, m: float = 10.0) -> DataFrame:
    """(column, category, fold, n, encoding): each fold's encoding from all other folds.

    One aggregate per (category, fold); what the other folds hold is the category total minus the
    fold's own share, so there is no pass per fold.
    """
    sums = category_sums(df, cols, label, [fold])
    totals = sums.groupBy("column", "category").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"))
    once = _of_first(sums, cols)
    folds = once.groupBy(fold).agg(F.sum("n").alias("__nf"), F.sum("s").alias("__sf"))
    whole = once.agg(F.struct(F.sum("n").alias("n"), F.sum("s").alias("s"))).scalar()
    priors = folds.select(
        fold, ((whole["s"] - F.col("__sf")) / (whole["n"] - F.col("__nf"))).alias("prior")
    )
    joined = sums.join(totals, ["column", "category"]).join(F.broadcast(priors), fold)
    n_rest, s_rest = F.col("n_all") - F.col("n"), F.col("s_all") - F.col("s")
    rest = F.when(n_rest > 0, m_estimate(s_rest, n_rest, F.col("prior"), m)).otherwise(F.col("prior"))
    return joined.select("column", "category", fold, "n", rest.alias("encoding"))


def apply_fold_encoding(
    df: DataFrame,
    table: DataFrame,
    cols: Sequence[str],
    fold: str,
    suffix: str = "_TE",
    spread_by: Sequence[str] | None = None,
    known_rows: int | None = None,
    also: Sequence[str] = (),
) -> DataFrame:
    """Add <col>_TE from a table of encodings per fold. also: further key columns that both sides have."""
    for c in cols:
        one = table.where(F.col("column") == c).select(F.col("category").alias("__category"), fold, *also, "n", "encoding")
        keyed = df.withColumn("__category", as_category(c))
        joined = lookup_join(keyed, one, ["__category", fold, *also], "n", ["encoding"], spread_by, known_rows)
        df = joined.withColumnRenamed("encoding", f"{c}{suffix}").drop("__category")
    return df


def effective_folds(df: DataFrame, label: str, folds: int) -> int:
    """Folds that the rows and the smallest class allow; below 2 the plain encoding is to be used."""
    row = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("rows"), F.min("n").alias("smallest")
    ).first()
    smallest = row["smallest"] if row["classes"] > 1 else 0
    return min(folds, row["rows"] or 0, smallest or 0)


def freeze_categories(df: DataFrame, cols: Sequence[str], most: int = 10_000) -> dict[str, list[str]]:
    """Sorted distinct values at fit, per column with at most `most` of them: those become columns of the wide form.

    Wider columns are not in the result; `category_index` numbers their values in Spark, and `sparse_flags` makes one vector of them.
    The rows are read once, and become one for each combination of categories before they are told apart by column.
    """
    cells = [F.struct(F.lit(c).alias("column"), as_category(c).alias("category")) for c in cols]
    distinct = durable(df.select(*cols).distinct().select(F.inline(F.array(*cells))).distinct())
    sizes = {r["column"]: r["n"] for r in distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    narrow = [c for c in cols if sizes.get(c, 0) <= most]
    rows = distinct.where(F.col("column").isin(narrow)).collect()
    return {c: sorted(r["category"] for r in rows if r["column"] == c) for c in narrow}


def category_index(df: DataFrame, c: str) -> DataFrame:
    """(category, n, index) at fit, numbered from 0 in the order of the values, for a column of any number of values."""
    counts = df.groupBy(as_category(c).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, ["category"], "index")


def apply_category_index(df: DataFrame, table: DataFrame, c: str, known_rows: int | None = None) -> DataFrame:
    """Add <c>_index, the place of the one flag that would be 1 in the wide form; -1 for values not known at fit."""
    keyed = df.withColumn("category", as_category(c))
    joined = lookup_join(keyed, table, ["category"], "n", ["index"], df.columns, known_rows)
    return joined.withColumn(f"{c}_index", F.coalesce("index", F.lit(-1))).drop("category", "index")


def flag_encoder(c: str, categories: int, drop_first: bool = True) -> OneHotEncoderModel:
    """Turns <c>_index into <c>_flags, a sparse vector with a place for each category (but the first); unseen values are all 0.

    Fitted on the one number that it needs, so no data is read.
    """
    spark = SparkSession.active()
    size = max(categories - int(drop_first), 1)
    # the last place stands for values without a flag, and is dropped
    encoder = OneHotEncoder(inputCols=[f"__{c}_place"], outputCols=[f"{c}_flags"], handleInvalid="keep", dropLast=True)
    return encoder.fit(spark.createDataFrame([(float(size - 1),)], f"`__{c}_place` double"))


def sparse_flags(
    df: DataFrame, table: DataFrame, c: str, encoder: OneHotEncoderModel, drop_first: bool = True, known_rows: int | None = None
) -> DataFrame:
    """Replace a column of any number of categories by <c>_flags. table: of `category_index`."""
    size = encoder.categorySizes[0]
    place = F.col(f"{c}_index") - int(drop_first)
    indexed = apply_category_index(df, table, c, known_rows)
    placed = indexed.withColumn(f"__{c}_place", F.when((place >= 0) & (place < size), place).otherwise(size).cast("double"))
    return encoder.transform(placed).drop(c, f"{c}_index", f"__{c}_place")


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], drop_first: bool = True) -> DataFrame:
    """Replace each column by <col>_<value> flags. The first category is left out; unseen values are all 0."""
    flags = {
        f"{c}_{v}": (as_category(c) == F.lit(v)).cast("int")
        for c, values in categories.items()
        for v in values[1 if drop_first else 0 :]
    }
    return df.withColumns(flags).drop(*categories)


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Force the column list: absent ones are 0, the others are dropped."""
    return df.select(*keep, *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns])


def select_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Keep the named columns. Absent names are skipped, or refused with strict=True."""
    absent = [c for c in columns if c not in df.columns]
    if absent and strict:
        raise ValueError(f"columns not found: {absent}")
    return df.select(*[c for c in columns if c in df.columns])


def drop_label(df: DataFrame, label: str) -> DataFrame:
    return df.drop(label)
