"""Queries: Spark ML training, out-of-fold scores, ensembles, calibration, selection, search, attribution."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from driftloom.operators import attribution, folds, metrics, scoring
from driftloom.plans import benchmark, calibration, features, imputer, oof, search, selection, stacking, training
from driftloom.plans.learners import Learner, from_search
from driftloom.session import durable
from driftloom.specs import SEARCH_SPACES, Space
from workload.fixtures import gaps, signal_label
from workload.registry import load, query, r6

LOGISTIC = Learner("logistic", "logistic", {"regParam": 0.01, "maxIter": 20})
BOOSTED = Learner("boosted", "gbt", {"maxIter": 20, "maxDepth": 3})
FOREST = Learner("forest", "forest", {"numTrees": 100, "maxDepth": 5})
TEXT_FEATURES = ["n_chars", "words", "lines", "digit_share"]


def _items(spark, sf):
    """Line items with a label that the quantity predicts; the id is a hash of the whole row."""
    rows = load(spark, sf, "lineitem")
    rows = rows.select(
        F.xxhash64(*rows.columns).alias("id"), signal_label().alias("label"), "l_quantity", "l_discount", "l_tax"
    )
    return VectorAssembler(inputCols=["l_quantity", "l_discount", "l_tax"], outputCol="features").transform(rows)


def _counted(docs, *keep):
    """Simple counts over whole texts."""
    text = F.col("text")
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    rows = docs.select(
        "doc_id",
        *keep,
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("words"),
        F.size(F.split(text, "\n")).cast("double").alias("lines"),
        (digits / F.greatest(F.col("n_chars"), F.lit(1))).alias("digit_share"),
    )
    return VectorAssembler(inputCols=TEXT_FEATURES, outputCol="features").transform(rows)


def _texts(spark, sf):
    """Labelled documents with their counts."""
    docs = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    return durable(folds.stratified_folds(_counted(docs, F.col("quality").alias("label")), "label", "doc_id", 3))


@query()
def oof_scores(spark, sf):
    rows = durable(_items(spark, sf).withColumn("fold", folds.hashed_fold("id", 3)))
    scores = oof.out_of_fold(rows, lambda: LOGISTIC.estimator(), "fold", 3, ["label"])
    return r6(metrics.ranking_metrics(durable(scores), "label", "p", ["fold"]))


@query()
def fold_mean_scores(spark, sf):
    """Documents without a label, scored by the mean of the fold models."""
    models = oof.fold_models(_texts(spark, sf), lambda: LOGISTIC.estimator(), "fold", 3)
    unlabelled = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left_anti")
    return r6(oof.mean_of_folds(_counted(unlabelled), models, ["doc_id"]))


@query()
def gbt_oof(spark, sf):
    rows = _texts(spark, sf)
    scores = oof.out_of_fold(rows, lambda: BOOSTED.estimator(), "fold", 3, ["label"])
    return r6(metrics.ranking_metrics(durable(scores), "label", "p", ["fold"]))


@query()
def voting(spark, sf):
    rows = _texts(spark, sf)
    model = stacking.VotingEstimator([LOGISTIC, FOREST], [1.5, 1.1]).fit(rows)
    return r6(model.transform(rows).select("doc_id", scoring.positive_probability().alias("p"), "prediction"))


@query()
def stacking_weights(spark, sf):
    rows = _texts(spark, sf).drop("fold")
    model = stacking.StackingEstimator([LOGISTIC, BOOSTED, FOREST], "doc_id", folds=5).fit(rows)
    return r6(model.weights(spark), 4)


@query()
def calibrated_isotonic(spark, sf):
    rows = _items(spark, sf).select("id", "label", "features")
    model = calibration.CalibratedEstimator(lambda: LOGISTIC.estimator(), "id", method="isotonic", folds=3).fit(rows)
    scored = model.transform(rows).select("label", scoring.positive_probability().alias("p"))
    return r6(metrics.reliability(durable(scored), "label", "p"))


@query()
def calibrated_sigmoid(spark, sf):
    rows = _items(spark, sf).select("id", "label", "features")
    model = calibration.CalibratedEstimator(lambda: LOGISTIC.estimator(), "id", method="sigmoid", folds=3).fit(rows)
    scored = model.transform(rows).select("label", scoring.positive_probability().alias("p"))
    return r6(metrics.brier(durable(scored), "label", "p"))


@query()
def feature_elimination(spark, sf):
    rows = _texts(spark, sf).drop("features")
    found = selection.select_features(rows, TEXT_FEATURES, LOGISTIC, "label", "fold", 3)
    return r6(found.sizes)


SMALL_SPACES = {
    "GBM": tuple(Space("n_estimators", 2, 4, step=1, integer=True) if s.name == "n_estimators" else s for s in SEARCH_SPACES["GBM"]),
    "XGB": tuple(Space("n_estimators", 2, 4, step=1, integer=True) if s.name == "n_estimators" else s for s in SEARCH_SPACES["XGB"]),
}


@query()
def random_search(spark, sf):
    trials = search.draw_trials(2, SMALL_SPACES)
    return r6(search.random_search(_texts(spark, sf), "label", "fold", 3, trials, from_search))


@query()
def model_benchmark(spark, sf):
    candidates = {m.name: (lambda m=m: m.estimator()) for m in (LOGISTIC, FOREST)}
    candidates["voting"] = lambda: stacking.VotingEstimator([LOGISTIC, FOREST], [1.5, 1.1])
    return benchmark.run_benchmark(_texts(spark, sf), candidates, "doc_id", "label", "fold", 3)


@query()
def shap_sampled(spark, sf):
    rows = _texts(spark, sf)
    model = LOGISTIC.estimator().fit(rows)
    return r6(attribution.shapley_sampled(rows.drop("features"), model, TEXT_FEATURES, "doc_id", rows, 4))


@query()
def permutation_importance(spark, sf):
    rows = _texts(spark, sf)
    model = LOGISTIC.estimator().fit(rows)
    return r6(attribution.permutation_importance(rows.drop("features"), model, TEXT_FEATURES, "label", "doc_id"))


PASSENGERS = """
SELECT CAST(c_custkey AS INT) AS PassengerId, CAST(c_custkey % 3 + 1 AS INT) AS Pclass,
  concat(c_name, ', ', CASE c_custkey % 5 WHEN 0 THEN 'Mrs' WHEN 1 THEN 'Mr' WHEN 2 THEN 'Miss' WHEN 3 THEN 'Dr' ELSE 'Mr' END, '. ', c_mktsegment) AS Name,
  CASE WHEN c_custkey % 5 IN (0, 2) THEN 'female' ELSE 'male' END AS Sex,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey * 13 % 71 AS DOUBLE) END AS Age,
  CAST(c_custkey % 4 AS INT) AS SibSp, CAST(c_custkey % 3 AS INT) AS Parch,
  CASE WHEN c_custkey % 2 = 0 THEN concat('PC ', c_custkey % 400) ELSE CAST(c_custkey % 300 AS STRING) END AS Ticket,
  CASE WHEN c_custkey % 31 <> 0 THEN c_acctbal / 50 + 25 END AS Fare,
  CASE WHEN c_custkey % 3 = 0 THEN concat(substr(c_mktsegment, 1, 1), c_custkey) END AS Cabin,
  CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_nationkey < 8 THEN 'C' WHEN c_nationkey < 16 THEN 'Q' ELSE 'S' END AS Embarked,
  CAST((c_custkey % 5 IN (0, 2) AND c_custkey % 11 <> 0) OR c_custkey % 13 = 0 AS INT) AS Survived
FROM customer
"""


def _passengers(spark, sf):
    load(spark, sf, "customer").createOrReplaceTempView("customer")
    return spark.sql(PASSENGERS)


@query()
def feature_builder(spark, sf):
    model, rows = features.FeatureBuilder().fit_transform(_passengers(spark, sf))
    return r6(rows)


@query()
def train_job(spark, sf):
    records = _passengers(spark, sf)
    config = training.TrainConfig("single", bases=[LOGISTIC], folds=2, select=False, calibrate="sigmoid")
    result = training.train(records, config)
    return training.score(result.pipeline, records.drop("Survived"), "PassengerId", result.threshold)


@query()
def impute_auto(spark, sf):
    df = durable(gaps(spark, sf).select("o_orderkey", "x1", "x2", "x3"))
    model = imputer.MissingImputer(["x1", "x2", "x3"], "auto", id_col="o_orderkey").fit(df)
    return r6(model.transform(df), 4)
