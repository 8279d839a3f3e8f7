"""Numbers for the rows of a global order, without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftloom.session import durable


def numbered(df: DataFrame, order: Sequence[str], out: str, first: int = 0) -> DataFrame:
    """df with `out`: the place of each row in the order, from `first`. Rows that are equal in it are numbered in any order.

    Range partitions are sorted on their own; one count per partition gives each its offset. The partitions are stored,
    so the numbers are the same however often they are read.
    """
    cut = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    cut = durable(cut)
    sizes = sorted((r["__part"], r["n"]) for r in cut.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], first
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    table = df.sparkSession.createDataFrame(offsets, "__part int, __offset long")
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    # one row per partition
    placed = cut.withColumn("__nth", within).join(F.broadcast(table), "__part")
    return placed.withColumn(out, F.col("__offset") + F.col("__nth") - 1).drop("__part", "__nth", "__offset")
