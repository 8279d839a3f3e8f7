"""Isotonic regression without a single task that holds all points.

Points are pooled within ranges of the score first: adjacent blocks whose means do not rise become one. Pooling blocks of blocks gives
the same answer as pooling the points, in whatever order, so ranges are then pooled with their neighbours, with alternating
boundaries, until no boundary changes anything. As a rule few blocks are left after the first step, and the second is the last.
The map is a table of blocks, which scores are joined with by range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.columns import bucket_index, nan_to_null
from driftloom.functions.joins import BROADCAST_ROWS
from driftloom.operators.ecdf import ROWS_PER_BUCKET, profile
from driftloom.session import durable

# Ranges that are pooled together in one round, and edges that cut the finished map for the join.
FAN = 8
EDGES = 64


def pool(low: np.ndarray, high: np.ndarray, weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """First block of each pool, in order: blocks sorted by score, whose means total / weight do not rise, are pooled with the one before."""
    first: list[int] = []
    sums: list[tuple[float, float]] = []
    for i, (w, t) in enumerate(zip(weight.tolist(), total.tolist(), strict=True)):
        begin = i
        while sums and sums[-1][1] * w >= t * sums[-1][0]:
            w, t = w + sums[-1][0], t + sums[-1][1]
            begin = first.pop()
            sums.pop()
        first.append(begin)
        sums.append((w, t))
    return np.array(first, np.int64)


def _pooled(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("low")
    part, low, high, weight, total = (rows.column(c).to_numpy() for c in ("part", "low", "high", "weight", "total"))
    first = pool(low, high, weight, total)
    last = np.append(first[1:], len(low)) - 1
    return pa.table(
        {"part": part[first], "low": low[first], "high": high[last], "weight": np.add.reduceat(weight, first), "total": np.add.reduceat(total, first)}
    )


SHAPE = "part long, low double, high double, weight double, total double"


def fit_isotonic(points: DataFrame, score: str, share: str, weight: str, rows_per_range: int = ROWS_PER_BUCKET) -> DataFrame:
    """(low, high, value, weight): the blocks of the increasing step function nearest to `share` by weighted squares, in order of score.

    points: distinct scores with their mean label and weight. Points with a missing value or no weight take no part. Blocks of at
    most rows_per_range are pooled in one task at last; more are pooled with their neighbours only.
    """
    x, w = nan_to_null(score), F.col(weight).cast("double")
    good = points.select(x.alias("low"), nan_to_null(share).alias("y"), w.alias("weight")).where("low is not null and y is not null and weight > 0")
    good = durable(good)
    edges = profile(good, ["low"], rows_per_bucket=rows_per_range).splits["low"]
    if edges:
        cuts = Bucketizer(inputCol="low", outputCol="__part", splits=[float("-inf"), *edges, float("inf")], handleInvalid="keep")
        good = cuts.transform(good)
    part = F.col("__part").cast("long") if edges else F.lit(0).cast("long")
    blocks = good.select(part.alias("part"), "low", F.col("low").alias("high"), "weight", (F.col("y") * F.col("weight")).alias("total"))
    blocks = durable(blocks.groupBy("part").applyInArrow(_pooled, SHAPE))
    size, calm, turn = blocks.count(), 0, 0
    while edges and calm < 2:
        if size <= rows_per_range:
            blocks = durable(blocks.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInArrow(_pooled, SHAPE))
            break
        # one row per range: they are numbered anew, as ranges that were pooled away leave gaps
        number = blocks.select("part").distinct().select("part", (F.row_number().over(Window.orderBy("part")) - 1).alias("nth"))
        group = F.floor((F.col("nth") + (turn % 2) * (FAN // 2)) / FAN).alias("group")
        placed = blocks.join(F.broadcast(number), "part").select("part", "low", "high", "weight", "total", group)
        blocks = durable(placed.groupBy("group").applyInArrow(_pooled, SHAPE))
        after = blocks.count()
        calm, size, turn = (calm + 1 if after == size else 0), after, turn + 1
    return blocks.select("low", "high", (F.col("total") / F.col("weight")).alias("value"), "weight")


def lay_out(blocks: DataFrame) -> tuple[DataFrame, list[float]]:
    """(table, edges) for `apply_map`. table: (bucket, low, high, value, next_low, next_value), with a null low for the first block, which
    also stands for what is below it, and a null next_low for the last. edges: numbers that cut the blocks into buckets."""
    row = blocks.agg(F.percentile_approx("low", [i / EDGES for i in range(1, EDGES)], 4 * EDGES)).first()
    edges = sorted(set(row[0] or []))
    placed = blocks.select(_bucket("low", edges).alias("bucket"), "low", "high", "value")
    # the block after the last one of a bucket is the first of the next bucket that has any: at most EDGES of them
    firsts = placed.groupBy("bucket").agg(F.min(F.struct("low", "value")).alias("first"))
    along = Window.orderBy("bucket")
    firsts = firsts.select("bucket", F.lead("first").over(along).alias("after"), (F.lag("bucket").over(along).isNull()).alias("lowest"))
    inside = Window.partitionBy("bucket").orderBy("low")
    told = placed.join(F.broadcast(firsts), "bucket").select(
        "bucket", "high", "value", "low", "lowest",
        F.coalesce(F.lead(F.struct("low", "value")).over(inside), F.col("after")).alias("next"),
        F.row_number().over(inside).alias("nth"),
    )
    # what is below the first block has its value too
    open_ = F.col("lowest") & (F.col("nth") == 1)
    told = told.select(
        F.when(open_, 0).otherwise(F.col("bucket")).alias("bucket"), F.when(~open_, F.col("low")).alias("low"), "high", "value",
        F.col("next.low").alias("next_low"), F.col("next.value").alias("next_value"),
    )
    return durable(told), edges


def _bucket(c: str, edges: list[float]):
    return (F.coalesce(bucket_index(c, edges), F.lit(0)) if edges else F.lit(0)).cast("int")


def apply_map(df: DataFrame, table: DataFrame, edges: list[float], score: str, out: str, known_rows: int) -> DataFrame:
    """Add the mapped score: constant within a block, linear between blocks, the first and last value outside them.

    Null for a missing score, and for all if the map is empty. A score meets the blocks of its bucket only; the table is broadcast if
    its known rows are few.
    """
    last = F.when(F.col("next_low").isNull(), F.lit(len(edges))).otherwise(_bucket("next_low", edges))
    spans = F.explode(F.sequence(F.col("bucket"), last)).alias("__of")
    side = table.select(spans, *[F.col(c).alias(f"__{c}") for c in ("low", "high", "value", "next_low", "next_value")])
    if known_rows <= BROADCAST_ROWS:
        side = F.broadcast(side)
    keyed = df.withColumn("__x", nan_to_null(score)).withColumn("__b", F.when(F.col("__x").isNotNull(), _bucket("__x", edges)))
    here = "(__low is null or __low <= __x) and (__next_low is null or __x < __next_low)"
    joined = keyed.join(side, F.expr(f"__b = __of and {here}"), "left")
    between = F.col("__value") + (F.col("__next_value") - F.col("__value")) * (F.col("__x") - F.col("__high")) / (F.col("__next_low") - F.col("__high"))
    value = F.when(F.col("__next_low").isNull() | (F.col("__x") <= F.col("__high")), F.col("__value")).otherwise(between)
    return joined.select(*[c for c in df.columns if c != out], value.alias(out))
