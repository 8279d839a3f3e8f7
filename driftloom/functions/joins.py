"""Joins of a big table with an aggregated lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least this share of the rows, so there are never more than 1000 of them.
HOT_SHARE = 0.001
SPREAD = 1024
# A table known to hold at most this many rows is sent whole.
BROADCAST_ROWS = 100_000


def row_bound(table: DataFrame) -> int:
    """Rows of a stored table, counted up to just above the broadcast limit."""
    return table.limit(BROADCAST_ROWS + 1).count()


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str,
    values: Sequence[str],
    spread_by: Sequence[str] | None = None,
    known_rows: int | None = None,
) -> DataFrame:
    """Left join with a table that holds one row per key, safe for hot keys and for big tables.

    With `known_rows` at or below BROADCAST_ROWS the table is broadcast as it is. Otherwise the keys of the left side are
    counted: those with a thousandth of all rows or more (at most 1000, by arithmetic; NULL and keys that the table
    does not have are counted too) get their values from the table once and are matched by a broadcast join. The others go
    through an ordinary shuffle join, which AQE turns into a broadcast when the table turns out to be small. Rows with a
    hot key carry a random-looking second key there, so that none of them meet in one task. `weight` names the table's
    column of rows behind each key, which is at least 0.
    """
    if known_rows is not None and known_rows <= BROADCAST_ROWS:
        small = table.select(*[F.col(k).alias(f"__h_{k}") for k in on], *[F.col(v).alias(f"__h_{v}") for v in values])
        same = [left[k].eqNullSafe(small[f"__h_{k}"]) for k in on]
        joined = left.join(F.broadcast(small), same, "left")
        return joined.select(*left.columns, *[F.col(f"__h_{v}").alias(v) for v in values])
    # 0, but not a literal: a literal would be moved out of the join's keys, and rows of a hot key would meet again
    zero = F.least(F.col(weight).cast("int"), F.lit(0))
    tails = table.select(*[F.col(k).alias(f"__t_{k}") for k in on], zero.alias("__t_spread"), *[F.col(v).alias(f"__t_{v}") for v in values])
    counted = left.groupBy(*[F.col(k).alias(f"__h_{k}") for k in on]).agg(F.count(F.lit(1)).alias("__rows"))
    often = counted.where(F.col("__rows") >= HOT_SHARE * left.count())
    of_table = [often[f"__h_{k}"].eqNullSafe(tails[f"__t_{k}"]) for k in on]
    heads = often.join(tails, of_table, "left").select(
        *[f"__h_{k}" for k in on], F.lit(True).alias("__hot"), *[F.col(f"__t_{v}").alias(f"__h_{v}") for v in values]
    )
    by_head = [left[k].eqNullSafe(heads[f"__h_{k}"]) for k in on]
    matched = left.join(F.broadcast(heads), by_head, "left")
    spread = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(SPREAD)) + 1
    matched = matched.withColumn("__spread", F.when(F.col("__hot"), spread).otherwise(0).cast("int"))
    by_tail = [matched[k].eqNullSafe(tails[f"__t_{k}"]) for k in on] + [matched["__spread"] == tails["__t_spread"]]
    joined = matched.join(tails, by_tail, "left")
    return joined.select(*left.columns, *[F.coalesce(f"__h_{v}", f"__t_{v}").alias(v) for v in values])
