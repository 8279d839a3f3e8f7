"""Fold assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import col
from driftloom.operators.ecdf import ROWS_PER_BUCKET, bucketed_ranks, row_ranks

HASH_BITS = 63


def hashed_fold(id_col: str, k: int, seed: int = 42) -> Column:
    """Fold by a hash of the id: no shuffle, equal class shares in expectation, stable under retries."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(k)).cast("int")


def stratified_folds(
    df: DataFrame,
    label: str,
    id_col: str,
    k: int = 5,
    seed: int | None = 42,
    out: str = "fold",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Folds whose class sizes differ by at most one row, shuffled by seed or (seed=None) in id order.

    A row's fold is its rank within its class modulo k. With a seed the rank runs over a hash of the id,
    whose high bits cut it into even buckets without looking at the data; so a class that holds nearly
    all rows is still ranked in many tasks.
    """
    if seed is None:
        ranked = row_ranks(df, id_col, [label], "__rank", rows_per_bucket=rows_per_bucket)
    else:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        bits = max(4, (2 * partitions - 1).bit_length())
        mixed = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 1)
        placed = df.withColumn("__mixed", mixed).withColumn(
            "bucket", F.shiftrightunsigned("__mixed", HASH_BITS - bits)
        )
        order = F.struct("__mixed", id_col)
        ranked = bucketed_ranks(placed, order, [label], "__rank").drop("__mixed")
    return ranked.withColumn(out, (F.col("__rank") % k).cast("int")).drop("__rank")


def fold_filter(fold: str, which: int) -> tuple[Column, Column]:
    """(training rows, held-out rows) of one fold."""
    return col(fold) != which, col(fold) == which
