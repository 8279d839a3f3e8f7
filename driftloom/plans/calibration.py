"""Probability calibration on held-out folds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.joins import row_bound
from driftloom.operators import isotonic
from driftloom.operators.folds import stratified_folds
from driftloom.operators.scoring import positive_probability
from driftloom.plans.learners import SEED
from driftloom.plans.oof import PARALLEL_FITS, fit_parallel
from driftloom.plans.persist import ComposedModel
from driftloom.session import durable


class CalibratedModel(ComposedModel):
    """The mean of k calibrated models. state: method, folds. models: base_<f> and map_<f>."""

    def _transform(self, df: DataFrame) -> DataFrame:
        frame = df
        used = []
        for f in range(self.state["folds"]):
            before = frame.columns
            frame = self.models[f"base_{f}"].transform(frame).select(*before, positive_probability().alias("__score"))
            mapped = self.models[f"map_{f}"]
            if self.state["method"] == "isotonic":
                frame = mapped.transform(frame).select(*before, F.col("__calibrated").alias(f"__p{f}"))
            else:
                frame = VectorAssembler(inputCols=["__score"], outputCol="__one").transform(frame)
                frame = mapped.transform(frame).select(*before, positive_probability("__map").alias(f"__p{f}"))
            used.append(F.col(f"__p{f}"))
        p = reduce(lambda a, b: a + b, used) / len(used)
        return frame.withColumn("__p", p).select(
            *df.columns,
            array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))).alias("probability"),
            (F.col("__p") >= 0.5).cast("double").alias("prediction"),
        )


class IsotonicMap(ComposedModel):
    """From __score to __calibrated. state: edges, rows (up to the broadcast limit). tables: blocks, as isotonic.lay_out makes them."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return isotonic.apply_map(df, self.tables["blocks"], self.state["edges"], "__score", "__calibrated", self.state["rows"])


def fit_map(scores: DataFrame, label: str, score: str, method: str):
    """The map from a score to a calibrated probability.

    Equal scores are merged into one weighted point first, so a score that many rows share is one row.
    """
    points = scores.groupBy(F.col(score).alias("__score")).agg(
        F.avg(F.col(label).cast("double")).alias("__share"), F.count(F.lit(1)).cast("double").alias("__weight")
    )
    if method == "isotonic":
        blocks = durable(isotonic.fit_isotonic(points, "__score", "__share", "__weight"))
        table, edges = isotonic.lay_out(blocks)
        return IsotonicMap({"edges": edges, "rows": row_bound(table)}, {"blocks": table})
    if method == "sigmoid":
        both = points.select(
            "__score",
            F.inline(
                F.array(
                    F.struct(F.lit(1.0).alias("__y"), (F.col("__share") * F.col("__weight")).alias("__w")),
                    F.struct(F.lit(0.0).alias("__y"), ((1 - F.col("__share")) * F.col("__weight")).alias("__w")),
                )
            ),
        ).where(F.col("__w") > 0)
        vectors = VectorAssembler(inputCols=["__score"], outputCol="__one").transform(both)
        return LogisticRegression(
            featuresCol="__one", labelCol="__y", weightCol="__w", probabilityCol="__map", rawPredictionCol="__map_raw", predictionCol="__map_class"
        ).fit(vectors)
    raise ValueError(f"unknown method {method}")


class CalibratedEstimator(Estimator):
    """Per fold: fit the base on the other folds, then the calibration map on the held-out scores."""

    def __init__(
        self,
        make: Callable[[], Estimator],
        id_col: str,
        label: str = "label",
        method: str = "isotonic",
        folds: int = 5,
        parallel: int = PARALLEL_FITS,
    ):
        super().__init__()
        self.make, self.id_col, self.label = make, id_col, label
        self.method, self.folds, self.parallel = method, folds, parallel

    def _fit(self, df: DataFrame) -> CalibratedModel:
        rows = durable(stratified_folds(df, self.label, self.id_col, self.folds, SEED, "__fold"))

        def one(f: int):
            base = self.make().fit(rows.where(F.col("__fold") != f).drop("__fold"))
            held_out = base.transform(rows.where(F.col("__fold") == f).drop("__fold"))
            scores = durable(held_out.select(self.label, positive_probability().alias("__held")))
            return base, fit_map(scores, self.label, "__held", self.method)

        fitted = fit_parallel([lambda f=f: one(f) for f in range(self.folds)], self.parallel)
        models = {}
        for f, (base, mapped) in enumerate(fitted):
            models[f"base_{f}"], models[f"map_{f}"] = base, mapped
        return CalibratedModel({"method": self.method, "folds": self.folds}, models=models)
