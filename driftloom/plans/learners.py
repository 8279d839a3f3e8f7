"""Base learners as Spark ML estimators."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

SEED = 42


@dataclass(frozen=True)
class Learner:
    """A named family (gbt, forest or logistic) with Spark ML parameters."""

    name: str
    family: str
    params: Mapping = field(default_factory=dict)

    def estimator(self, features: str = "features", label: str = "label") -> Estimator:
        common = {"featuresCol": features, "labelCol": label}
        if self.family == "gbt":
            return GBTClassifier(seed=SEED, **common, **self.params)
        if self.family == "forest":
            return RandomForestClassifier(seed=SEED, **common, **self.params)
        if self.family == "logistic":
            return LogisticRegression(**common, **self.params)
        raise ValueError(f"unknown family {self.family}")


def logistic(name: str, c: float, rows: int, max_iter: int = 1000) -> Learner:
    """L2 logistic regression with inverse strength c: the penalty per row is 1 / (c * rows)."""
    params = {"regParam": 1.0 / (c * max(rows, 1)), "elasticNetParam": 0.0, "standardization": False, "maxIter": max_iter}
    return Learner(name, "logistic", params)


# Tuned and default settings of the published models, in Spark ML terms. The second and third
# booster stand in for engines that Spark does not ship, with other depths and row shares for diversity.
TUNED_GBM = Learner(
    "gbm",
    "gbt",
    {
        "maxIter": 450,
        "maxDepth": 4,
        "stepSize": 0.03836630493725778,
        "subsamplingRate": 0.6612627071218214,
        "minInstancesPerNode": 17,
    },
)
LEAF_WISE = Learner(
    "lgbm", "gbt", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8, "minInstancesPerNode": 20}
)
REGULARISED = Learner("xgb", "gbt", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8})
FOREST = Learner(
    "rf",
    "forest",
    {"numTrees": 200, "maxDepth": 6, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 2},
)
EXTRA_TREES = Learner(
    "et",
    "forest",
    {"numTrees": 250, "maxDepth": 7, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 2, "subsamplingRate": 0.8},
)
BENCH_GBM = Learner("gb", "gbt", {"maxIter": 150, "maxDepth": 4, "stepSize": 0.04, "subsamplingRate": 0.85})
BENCH_LGBM = Learner("lgb", "gbt", {"maxIter": 180, "maxDepth": 4, "stepSize": 0.03, "subsamplingRate": 0.85, "minInstancesPerNode": 20})
BENCH_XGB = Learner(
    "xgb", "gbt", {"maxIter": 150, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.85, "minInfoGain": 0.0}
)
STACK_BASES = (TUNED_GBM, LEAF_WISE, REGULARISED)
BENCH_LEARNERS = (FOREST, BENCH_GBM, EXTRA_TREES, BENCH_LGBM, BENCH_XGB)
VOTING_ORDER = ("gb", "xgb", "lgb", "et", "rf")
SHALLOW_META = Learner("shallow", "gbt", {"maxIter": 50, "maxDepth": 2, "stepSize": 0.05, "subsamplingRate": 0.8})
META_C = 0.1


def from_search(family: str, drawn: Mapping) -> Learner:
    """A drawn set of hyper-parameters in Spark ML terms. Leaf penalties and leaf counts have no twin there."""
    params = {
        "maxIter": int(drawn["n_estimators"]),
        "stepSize": float(drawn["learning_rate"]),
        "subsamplingRate": float(drawn["subsample"]),
    }
    if "max_depth" in drawn:
        params["maxDepth"] = int(drawn["max_depth"])
    elif "num_leaves" in drawn:
        params["maxDepth"] = max(2, (int(drawn["num_leaves"]) - 1).bit_length())
    for name in ("min_samples_leaf", "min_child_samples", "min_child_weight"):
        if name in drawn:
            params["minInstancesPerNode"] = int(drawn[name])
    if "max_features" in drawn:
        params["featureSubsetStrategy"] = drawn["max_features"]
    elif "colsample_bytree" in drawn:
        params["featureSubsetStrategy"] = str(round(float(drawn["colsample_bytree"]), 3))
    if "gamma" in drawn:
        # gamma is a gain summed over a node's rows, minInfoGain a gain per row; the space was made for about 1000 rows
        params["minInfoGain"] = float(drawn["gamma"]) / 1000
    return Learner(family, "gbt", params)
