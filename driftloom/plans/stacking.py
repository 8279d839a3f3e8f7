"""Two-level stacking: out-of-fold scores of the base learners feed a meta learner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators.ensemble import soft_vote
from driftloom.operators.folds import hashed_fold, stratified_folds
from driftloom.operators.scoring import positive_probability
from driftloom.plans.learners import META_C, SEED, Learner, logistic
from driftloom.plans.oof import PARALLEL_FITS, fit_parallel
from driftloom.plans.persist import ComposedModel
from driftloom.session import durable

OUTPUTS = ("rawPrediction", "probability", "prediction")


def base_scores(df: DataFrame, models: dict, names: Sequence[str]) -> DataFrame:
    """Add p_<name> per base model; their other outputs are dropped again."""
    for name in names:
        before = df.columns
        df = models[name].transform(df).select(*before, positive_probability().alias(f"p_{name}"))
    return df


class StackingModel(ComposedModel):
    """state: names, meta features column. models: base_<name> and meta."""

    @property
    def names(self) -> list[str]:
        return self.state["names"]

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.names
        bases = {n: self.models[f"base_{n}"] for n in names}
        scored = base_scores(df, bases, names)
        stacked = VectorAssembler(inputCols=[f"p_{n}" for n in names], outputCol="__meta").transform(scored)
        return self.models["meta"].transform(stacked).select(*df.columns, *OUTPUTS)

    def weights(self, spark) -> DataFrame:
        """(model, weight): the meta learner's coefficients, with the intercept as a row of its own."""
        meta = self.models["meta"]
        if not hasattr(meta, "coefficients"):
            rows = list(zip(self.names, (float(v) for v in meta.featureImportances.toArray())))
        else:
            rows = list(zip(self.names, (float(v) for v in meta.coefficients.toArray())))
            rows.append(("intercept", float(meta.intercept)))
        return spark.createDataFrame(rows, "model string, weight double")


class StackingEstimator(Estimator):
    """Fits the bases on k-1 folds each to score the held-out rows, the meta learner on those scores, then the bases on all rows."""

    def __init__(
        self,
        bases: Sequence[Learner],
        id_col: str,
        label: str = "label",
        features: str = "features",
        folds: int = 5,
        meta: Learner | None = None,
        meta_c: float = META_C,
        exact_folds: bool = True,
        parallel: int = PARALLEL_FITS,
    ):
        super().__init__()
        self.bases, self.id_col, self.label, self.features = list(bases), id_col, label, features
        self.folds, self.meta, self.meta_c = folds, meta, meta_c
        self.exact_folds, self.parallel = exact_folds, parallel

    def _with_folds(self, df: DataFrame) -> DataFrame:
        needed = df.select(self.id_col, self.label, self.features)
        if self.exact_folds:
            return stratified_folds(needed, self.label, self.id_col, self.folds, SEED, "__fold")
        return needed.withColumn("__fold", hashed_fold(self.id_col, self.folds, SEED))

    def _fit(self, df: DataFrame) -> StackingModel:
        rows = durable(self._with_folds(df))

        def fit(learner: Learner, f: int | None):
            part = rows if f is None else rows.where(F.col("__fold") != f)
            return learner.estimator(self.features, self.label).fit(part)

        jobs = [(learner, f) for learner in self.bases for f in [*range(self.folds), None]]
        fitted = dict(zip(((j[0].name, j[1]) for j in jobs), fit_parallel([lambda j=j: fit(*j) for j in jobs], self.parallel)))
        names = [learner.name for learner in self.bases]
        parts = []
        for f in range(self.folds):
            mine = rows.where(F.col("__fold") == f)
            parts.append(base_scores(mine, {n: fitted[(n, f)] for n in names}, names).select(self.label, *[f"p_{n}" for n in names]))
        scores = parts[0]
        for part in parts[1:]:
            scores = scores.unionByName(part)
        stacked = durable(VectorAssembler(inputCols=[f"p_{n}" for n in names], outputCol="__meta").transform(scores))
        meta = self.meta or logistic("meta", self.meta_c, rows.count())
        meta_model = meta.estimator("__meta", self.label).fit(stacked)
        models = {f"base_{n}": fitted[(n, None)] for n in names}
        return StackingModel({"names": names}, models={**models, "meta": meta_model})


class VotingModel(ComposedModel):
    """state: names, weights. models: base_<name>."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.state["names"]
        scored = base_scores(df, {n: self.models[f"base_{n}"] for n in names}, names)
        p = soft_vote([f"p_{n}" for n in names], self.state["weights"])
        return (
            scored.withColumn("__p", p)
            .withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))))
            .withColumn("prediction", (F.col("__p") >= 0.5).cast("double"))
            .select(*df.columns, "probability", "prediction")
        )


class VotingEstimator(Estimator):
    """Weighted mean of the probabilities of several learners."""

    def __init__(self, bases: Sequence[Learner], weights: Sequence[float] | None = None, label: str = "label",
                 features: str = "features", parallel: int = PARALLEL_FITS):
        super().__init__()
        self.bases, self.label, self.features, self.parallel = list(bases), label, features, parallel
        self.weights = list(weights or [1.0] * len(self.bases))

    def _fit(self, df: DataFrame) -> VotingModel:
        fits = [lambda b=b: b.estimator(self.features, self.label).fit(df) for b in self.bases]
        models = fit_parallel(fits, self.parallel)
        names = [b.name for b in self.bases]
        return VotingModel(
            {"names": names, "weights": self.weights}, models={f"base_{n}": m for n, m in zip(names, models)}
        )
