"""Exact tree attribution against enumeration of all feature subsets."""

from itertools import chain, combinations
from math import comb

import numpy as np
import pandas as pd
import pytest
from driftloom.operators import trees
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

NAMES = ["a", "b", "c", "kind"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(6)
    n = 300
    x = np.column_stack([r.normal(0, 1, (n, 3)), r.integers(0, 4, n)])
    y = (x[:, 0] * x[:, 1] + (x[:, 3] == 2) + r.normal(0, 0.3, n) > 0.3).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), **{c: x[:, i] for i, c in enumerate(NAMES)}, "label": y}))
    df = VectorAssembler(inputCols=NAMES, outputCol="raw").transform(df)
    # the last feature is a category, so splits by sets of values occur
    from pyspark.ml.feature import VectorIndexer

    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(df).transform(df).cache()


def expectation(nodes, x, known, at=0):
    """Mean of a tree's leaves, where splits on unknown features send the row down both sides."""
    here = nodes[at]
    if here["left"] < 0:
        return here["value"]
    left, right = nodes[here["left"]], nodes[here["right"]]
    if here["feature"] in known:
        v = x[here["feature"]]
        goes_left = v in here["categories"] if here["categories"] is not None else v <= here["threshold"]
        return expectation(nodes, x, known, (left if goes_left else right)["node"])
    return sum(c["rows"] / here["rows"] * expectation(nodes, x, known, c["node"]) for c in (left, right))


def enumerated(table, x):
    phi = np.zeros(len(x))
    for tree in {r["tree"] for r in table}:
        nodes = {r["node"]: r for r in table if r["tree"] == tree}
        weight = nodes[0]["weight"]
        for i in range(len(x)):
            others = [j for j in range(len(x)) if j != i]
            for known in chain.from_iterable(combinations(others, k) for k in range(len(others) + 1)):
                gain = expectation(nodes, x, {*known, i}) - expectation(nodes, x, set(known))
                phi[i] += weight * gain / (len(x) * comb(len(x) - 1, len(known)))
    return phi


MODELS = [
    (GBTClassifier, {"maxIter": 4, "maxDepth": 4, "seed": 1}),
    (RandomForestClassifier, {"numTrees": 4, "maxDepth": 5, "seed": 1}),
    (DecisionTreeClassifier, {"maxDepth": 5}),
    (GBTRegressor, {"maxIter": 3, "maxDepth": 3, "seed": 1}),
    (RandomForestRegressor, {"numTrees": 3, "maxDepth": 4, "seed": 1}),
]


@pytest.mark.parametrize("learner,settings", MODELS)
def test_contributions_are_shapley_values_and_add_up(rows, learner, settings):
    model = learner(**settings).fit(rows)
    told = trees.attribute(model.transform(rows), model)
    kind = type(model).__name__
    own = F.col("prediction")
    if "Classif" in kind:
        own = vector_to_array("rawPrediction" if "GBT" in kind else "probability")[1]
    got = told.select("contributions", "margin", "expected", own.alias("own"), vector_to_array("features").alias("x")).collect()
    for r in got:
        assert r["margin"] == pytest.approx(r["own"], abs=1e-9)
        assert sum(r["contributions"]) == pytest.approx(r["own"] - r["expected"], abs=1e-9)
    table = trees.node_table(model).collect()
    assert "categories" in table[0] and any(r["categories"] for r in table)
    for r in got[::60]:
        assert np.allclose(r["contributions"], enumerated(table, r["x"]), atol=1e-9)


def test_deep_paths_with_many_features(spark):
    """A chain of 70 features: as many subsets as 2 ** 70, which the quadrature sums exactly (here in closed form)."""
    d = 70
    rows = []
    for i in range(d):
        rows.append({"tree": 0, "weight": 1.0, "node": 2 * i, "left": 2 * i + 1, "right": 2 * i + 2, "feature": i, "threshold": 0.5, "categories": None, "rows": 2.0 ** (d - i), "value": 0.0})
        rows.append({"tree": 0, "weight": 1.0, "node": 2 * i + 1, "left": -1, "right": -1, "feature": None, "threshold": None, "categories": None, "rows": 2.0 ** (d - i - 1), "value": 0.0})
    rows.append({"tree": 0, "weight": 1.0, "node": 2 * d, "left": -1, "right": -1, "feature": None, "threshold": None, "categories": None, "rows": 1.0, "value": 1.0})
    tree = trees._tree(rows)
    x = np.array([[1.0] * d, [1.0] * (d - 1) + [0.0]])
    phi, margin = trees.contributions([tree], x)
    assert margin.tolist() == [1.0, 0.0] and np.allclose(phi.sum(1), margin - tree.mean)
    assert np.allclose(phi[0], phi[0][0])  # all features play the same part
    assert phi[1][-1] < 0 < phi[1][0]


def test_rows_without_features_missing_values_and_names(spark, rows):
    model = DecisionTreeClassifier(maxDepth=3).fit(rows)
    given = spark.createDataFrame([(1, "old", [0.1, float("nan"), 0.3, 1.0]), (2, "old", None), (1, "old", [0.1, float("nan"), 0.3, 1.0])], "id long, margin string, x array<double>")
    table = trees.load_trees(trees.node_table(model))
    got = given.select("id", trees.tree_attribution("x", table, 4).alias("t")).collect()
    assert got[1]["t"] is None and got[0]["t"] == got[2]["t"] and len(got[0]["t"]["contributions"]) == 4
    from pyspark.ml.functions import array_to_vector

    vectors = given.where("x is not null").withColumn("features", array_to_vector("x"))
    told = trees.attribute(vectors, model)
    assert sorted(told.columns) == sorted(["id", "x", "features", "contributions", "margin", "expected"])
    own = model.transform(vectors).select(vector_to_array("probability")[1]).first()[0]
    assert told.first()["margin"] == pytest.approx(own)
    assert trees.attribute(vectors.limit(0), model).count() == 0


def test_importance_puts_the_noise_last(rows):
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(rows)
    told = {r["feature"]: r["mean_abs_contribution"] for r in trees.tree_importance(rows, model, NAMES).collect()}
    assert set(told) == set(NAMES) and min(told, key=told.get) == "c"


def test_only_tree_models(rows):
    with pytest.raises(ValueError):
        trees.node_table(LogisticRegression().fit(rows))
