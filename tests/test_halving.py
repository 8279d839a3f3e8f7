"""Staged scores of ensembles as data, and successive halving."""

import numpy as np
import pandas as pd
import pytest
from driftloom.operators import metrics, trees
from driftloom.operators.folds import stratified_folds
from driftloom.operators.scoring import positive_probability
from driftloom.plans import halving, oof, search
from driftloom.plans.learners import Learner
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_trees import rows as with_categories  # noqa: F401


@pytest.fixture(scope="module")
def folded(spark):
    r = np.random.default_rng(9)
    n = 240
    x = r.normal(0, 1, (n, 3))
    y = (x[:, 0] * x[:, 1] + r.normal(0, 0.4, n) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "label": y}))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    return stratified_folds(df, "label", "id", 3).cache()


def test_stages_are_the_smaller_ensembles(with_categories):  # noqa: F811
    """The first k trees are the model that is fitted with k trees."""
    fit = lambda k: GBTClassifier(maxIter=k, maxDepth=3, seed=1).fit(with_categories)
    forest = trees.load_forest(trees.node_table(fit(6)))
    got = with_categories.select("id", trees.side_by_side(vector_to_array("features"), F.lit(0), [[(forest, [1, 3, 6, 99])]]).alias("s"))
    got = {r["id"]: r["s"] for r in got.collect()}
    for i, k in enumerate((1, 3, 6)):
        own = fit(k).transform(with_categories).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()
        assert all(abs(got[r["id"]][i] - r["m"]) < 1e-9 for r in own)
    assert all(s[2] == s[3] for s in got.values())


def test_areas_are_those_of_out_of_fold_scores(folded):
    learner = Learner("b", "gbt", {"maxIter": 5, "maxDepth": 2})
    got = halving.staged_areas(folded.select("label", "fold", "features"), {7: learner}, "label", "fold", 3, {7: [5]}).first()
    scores = oof.out_of_fold(folded, lambda: learner.estimator(), "fold", 3, ["label"])
    want = metrics.ranking_metrics(scores, "label", "p", ["fold"]).agg(F.avg("auc")).first()[0]
    assert (got["trial"], got["trees"], got["folds"]) == (7, 5, 3) and got["mean_auc"] == pytest.approx(want, abs=1e-9)


def test_halving_keeps_the_best_by_the_stated_rule(folded):
    make = lambda family, p: Learner(family, "gbt", {"maxIter": 40, **p})
    trials = [{"trial": i, "family": "gbt", "params": {"maxDepth": d, "stepSize": 0.3}} for i, d in enumerate((1, 1, 3, 4, 1))]
    how = halving.Halving((3, 6, 9), 0.5, 3)
    table = halving.successive_halving(folded, "label", "fold", 3, trials, how, make).collect()
    sizes = [sum(r["rung"] == k for r in table) for k in range(3)]
    assert sizes == [5, 3, 2] and [sum(r["rung"] == k and r["survives"] for r in table) for k in range(3)] == [3, 2, 1]
    for k in range(3):
        order = sorted((r for r in table if r["rung"] == k), key=lambda r: (-r["mean_auc"], r["trial"]))
        assert all(r["survives"] == (i < (3, 2, 1)[k]) for i, r in enumerate(order))
        assert all(r["best_trees"] in (how.rungs[k] // 3, 2 * how.rungs[k] // 3, how.rungs[k]) and r["trees"] == how.rungs[k] for r in order)
    # depth 1 cannot tell a product
    assert halving.winner(folded.sparkSession.createDataFrame(table))["hyperparameters"]["maxDepth"] in (3, 4)


def test_trials_that_tie_small_requests_and_other_families(folded):
    trials = [{"trial": t, "family": "gbt", "params": {}} for t in (4, 2, 3)]
    make = lambda family, p: Learner(family, "gbt", {"maxIter": 2, "maxDepth": 1})
    table = halving.successive_halving(folded, "label", "fold", 3, trials, halving.Halving((2, 50), 1 / 3, 1), make).collect()
    assert [(r["rung"], r["trial"], r["trees"]) for r in table if r["survives"]] == [(0, 2, 2), (1, 2, 2)]
    with pytest.raises(ValueError):
        halving.successive_halving(folded, "label", "fold", 3, trials, to_learner=lambda f, p: Learner(f, "logistic", {}))


def test_rows_without_a_fold_or_vector_have_no_score(spark, folded):
    forest = trees.load_forest(trees.node_table(GBTClassifier(maxIter=2, maxDepth=2).fit(folded)))
    df = spark.createDataFrame([([0.1, 0.2, 0.3], 0), (None, 0), ([0.1, 0.2, 0.3], None), ([0.1, None, 0.3], 0), ([0.1, 0.2, 0.3], 5)], "x array<double>, f int")
    got = [r["s"] for r in df.select(trees.side_by_side("x", "f", [[(forest, [2])]]).alias("s")).collect()]
    assert [s is None for s in got] == [False, True, True, False, True]


def test_search_draws_can_be_halved(folded):
    trials = search.draw_trials(3)
    table = halving.successive_halving(folded, "label", "fold", 3, trials, halving.Halving((1, 2), 0.5, 1))
    assert table.where("rung = 0").count() == 3 and table.where("rung = 1").count() == 2
    assert positive_probability() is not None
