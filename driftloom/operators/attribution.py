"""Which features move the score: exact for linear models, sampled or by permutation for any model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null
from driftloom.functions.joins import BROADCAST_ROWS
from driftloom.functions.numbering import numbered
from driftloom.operators.ecdf import bucketed_ranks
from driftloom.operators.metrics import ranking_metrics
from driftloom.operators.scoring import positive_probability
from driftloom.session import durable


def linear_attribution(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(feature, mean_abs_contribution) of weight * (x - mean x), in two aggregates for all features."""
    names = list(weights)
    clean = df.select(*[nan_to_null(c).alias(f"__x{i}") for i, c in enumerate(names)])
    means = clean.agg(F.struct(*[F.avg(f"__x{i}").alias(f"m{i}") for i in range(len(names))])).scalar()
    row = clean.withColumn("__m", means).agg(
        *[
            F.avg(F.abs(F.lit(float(weights[c])) * (F.col(f"__x{i}") - F.col("__m")[f"m{i}"]))).alias(f"__a{i}")
            for i, c in enumerate(names)
        ]
    )
    lines = [
        F.struct(F.lit(c).alias("feature"), F.col(f"__a{i}").alias("mean_abs_contribution")) for i, c in enumerate(names)
    ]
    return row.select(F.inline(F.array(*lines)))


def _mixed(features: Sequence[str], order: str, step: Column, other: str) -> list[Column]:
    """Feature values of a row in which the first `step` features of its order come from the row itself."""
    return [
        F.when(F.array_position(F.col(order), F.lit(c)) <= step, F.col(c)).otherwise(F.col(f"{other}.{c}")).alias(c)
        for c in features
    ]


def shapley_sampled(
    df: DataFrame,
    model: Transformer,
    features: Sequence[str],
    id_col: str,
    background: DataFrame,
    permutations: int = 4,
    seed: int = 42,
    features_col: str = "features",
) -> DataFrame:
    """(feature, mean_abs_contribution) by sampled Shapley values.

    Each row is put through a few feature orders against background rows: features are switched from the
    background to the row one after the other, and the change of the probability belongs to the
    switched feature. Rows and orders are exploded, scored in one transform, and grouped.
    All rows of `background` that have a value for every feature can be drawn; they are numbered in Spark, and joined
    by their number: sent whole when they are few, by shuffle otherwise. Drawing is what this estimator does.
    """
    others = background.select(*[nan_to_null(c).alias(c) for c in features]).dropna()
    pool = durable(numbered(others, list(features), "__b").select("__b", F.struct(*features).alias("__other")))
    size = pool.count()
    if not size:
        raise ValueError("no background row has a value for every feature")
    if size <= BROADCAST_ROWS:
        pool = F.broadcast(pool)
    names = F.array(*[F.lit(c) for c in features])
    draw = F.xxhash64(F.col(id_col), F.col("__perm"), F.lit(seed))
    ordered = F.transform(
        F.array_sort(F.transform(names, lambda c: F.struct(F.xxhash64(draw, c).alias("k"), c.alias("c")))),
        lambda s: s["c"],
    )
    cast = [F.col(c).cast("double").alias(c) for c in features]
    drawn = (
        df.select(F.col(id_col), *cast)
        .withColumn("__perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
        .withColumn("__order", ordered)
        .withColumn("__b", F.pmod(F.xxhash64(draw, F.lit("b")), F.lit(size)))
        .join(pool, "__b")
    )
    steps = drawn.withColumn("__step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    points = steps.select(id_col, "__perm", "__order", "__step", *_mixed(features, "__order", F.col("__step"), "__other"))
    scored = model.transform(VectorAssembler(inputCols=list(features), outputCol=features_col).transform(points))
    path = scored.select(
        id_col, "__perm", "__order", F.struct("__step", positive_probability().alias("p")).alias("s")
    ).groupBy(id_col, "__perm", "__order").agg(F.array_sort(F.collect_list("s")).alias("__path"))
    # a path has one entry per feature plus one
    jumps = F.transform(
        F.sequence(F.lit(1), F.lit(len(features))),
        lambda i: F.struct(
            F.element_at("__order", i).alias("feature"),
            (F.element_at("__path", i + 1)["p"] - F.element_at("__path", i)["p"]).alias("delta"),
        ),
    )
    per_row = path.select(id_col, F.inline(jumps)).groupBy(id_col, "feature").agg(F.avg("delta").alias("phi"))
    return per_row.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_contribution"))


def permutation_importance(
    df: DataFrame,
    model: Transformer,
    features: Sequence[str],
    label: str,
    id_col: str,
    seed: int = 42,
    features_col: str = "features",
) -> DataFrame:
    """(feature, auc, auc_drop): loss of AUC when one feature is exchanged between rows.

    The exchange is a join on two independent hash orders of the same rows: both sides are ranked in
    even hash buckets, and each row takes the value of the row with its rank in the other order. All
    features are scored as one long table and the areas come from one grouped job.
    """
    base = df.select(F.col(id_col).alias("__id"), F.col(label).alias("__y"), *[F.col(c).cast("double").alias(c) for c in features])
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bits = max(4, (2 * partitions - 1).bit_length())

    def ranked(rows: DataFrame, salt: int) -> DataFrame:
        mixed = F.shiftrightunsigned(F.xxhash64(F.col("__id"), F.lit(seed), F.lit(salt)), 1)
        placed = rows.withColumn("__mixed", mixed).withColumn("bucket", F.shiftrightunsigned("__mixed", 63 - bits))
        return bucketed_ranks(placed, F.struct("__mixed", "__id"), [], "__rank").drop("__mixed")

    own = ranked(base, 1)
    lent = ranked(base, 2).select("__rank", F.struct(*features).alias("__lent"))
    pairs = own.join(lent, "__rank")
    variants = F.explode(F.array(*[F.lit(c) for c in ["", *features]])).alias("feature")
    points = pairs.select("__y", "__lent", *features, variants).select(
        "__y",
        "feature",
        *[F.when(F.col("feature") == c, F.col("__lent")[c]).otherwise(F.col(c)).alias(c) for c in features],
    )
    scored = model.transform(VectorAssembler(inputCols=list(features), outputCol=features_col).transform(points))
    flat = scored.select("feature", "__y", positive_probability().alias("__p"))
    areas = ranking_metrics(flat, "__y", "__p", ["feature"])
    base_auc = areas.where(F.col("feature") == "").select("auc").scalar()
    return areas.where(F.col("feature") != "").select("feature", "auc", (base_auc - F.col("auc")).alias("auc_drop"))
