"""Fitted tree models as a table of nodes, and the exact share of each feature in every score.

A feature that is not known at a split sends a row down both sides, weighted by the training rows that went there. The Shapley
value of a feature then is a sum over leaves. On the way to a leaf each feature has a share `z` of training rows that pass its
splits, and `o` (0 or 1): whether the row passes them. The weights of all subsets of known features, as the path is extended feature
by feature, are the coefficients of a product of terms z + o * s; averaging them over subset sizes is the integral of
prod(z * (1 - t) + o * t) over t from 0 to 1. It is a polynomial in t, so a Gauss rule with half as many points as features is
exact. At each point a feature is unwound by dividing by its own term. That is polynomial in the depth, where enumerating subsets is not.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.session import durable_dir

FORESTS = ("RandomForestClassificationModel", "RandomForestRegressionModel")
BOOSTED = ("GBTClassificationModel", "GBTRegressionModel")
SINGLE = ("DecisionTreeClassificationModel", "DecisionTreeRegressionModel")
# Rows whose contributions a task computes at once.
ROWS = 4096


def node_table(model: Model) -> DataFrame:
    """(tree, weight, node, left, right, feature, threshold, categories, rows, value): the nodes of a Spark tree model.

    left is -1 at leaves. Rows go left if the feature is at most `threshold`, or one of `categories` where that is not null. value: what the
    node adds to the margin (boosted trees), to the probability of class 1 (classifiers) or to the prediction (regressions),
    before it is multiplied by the tree's weight. Read from the model's own Parquet form, so nothing passes through the driver.
    """
    kind = type(model).__name__
    if kind not in FORESTS + BOOSTED + SINGLE:
        raise ValueError(f"not a tree model: {kind}")
    if "Classification" in kind and kind not in BOOSTED and model.numClasses > 2:
        raise ValueError("only two classes")
    spark = SparkSession.active()
    path = f"{durable_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if kind in SINGLE:
        nodes = data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), *data.columns)
    else:
        weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights")
        data = data.toDF("treeID", "nodeData")
        weight = F.col("weights").cast("double") if kind in BOOSTED else F.lit(1.0 / len(model.trees))
        # one row per tree
        weights = weights.select("treeID", weight.alias("weight"))
        nodes = data.join(F.broadcast(weights), "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")
    stats = F.col("impurityStats")
    value = F.col("prediction")
    if "Classification" in kind and kind not in BOOSTED:
        value = stats[1] / (stats[0] + stats[1])
    by_category = F.col("split.numCategories") >= 0
    split = F.col("split.leftCategoriesOrThreshold")
    leaf = F.col("leftChild") < 0
    return nodes.select(
        "tree",
        "weight",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf & ~by_category, F.get(split, F.lit(0))).alias("threshold"),
        F.when(~leaf & by_category, split).alias("categories"),
        F.col("rawCount").cast("double").alias("rows"),
        value.alias("value"),
    )


@dataclass(frozen=True)
class Leaf:
    """features: those on the path, once each; share: of the training rows that pass a feature's splits, as a product over them;
    steps: for each feature its splits, as (place of the node in the tree, goes left)."""

    value: float
    features: np.ndarray
    share: np.ndarray
    steps: tuple[tuple[tuple[int, bool], ...], ...]


@dataclass(frozen=True)
class Tree:
    """Inner nodes side by side, leaves with their paths, and the mean of the leaves over the training rows."""

    feature: np.ndarray
    threshold: np.ndarray
    categories: tuple[np.ndarray | None, ...]
    leaves: tuple[Leaf, ...]
    mean: float

    def left(self, x: np.ndarray) -> np.ndarray:
        """(rows, inner nodes): who goes left. A missing value is on no left side."""
        out = x[:, self.feature] <= self.threshold
        for i, categories in enumerate(self.categories):
            if categories is not None:
                out[:, i] = np.isin(x[:, self.feature[i]], categories)
        return out


def _tree(rows: list) -> Tree:
    by_id = {r["node"]: r for r in rows}
    inner = [r["node"] for r in rows if r["left"] >= 0]
    place = {node: i for i, node in enumerate(inner)}
    weight = rows[0]["weight"]
    leaves: list[Leaf] = []
    todo: list[tuple[int, dict[int, tuple[float, tuple]]]] = [(0, {})]
    while todo:
        node, path = todo.pop()
        here = by_id[node]
        if here["left"] < 0:
            share = np.array([z for z, _ in path.values()])
            leaves.append(Leaf(weight * here["value"], np.array(list(path), np.int64), share, tuple(s for _, s in path.values())))
            continue
        f = here["feature"]
        z, steps = path.get(f, (1.0, ()))
        for child, goes_left in ((here["left"], True), (here["right"], False)):
            passed = by_id[child]["rows"] / here["rows"] if here["rows"] else 0.5
            todo.append((child, {**path, f: (z * passed, (*steps, (place[node], goes_left)))}))
    top = [by_id[n] for n in inner]
    return Tree(
        np.array([r["feature"] for r in top], np.int64),
        np.array([np.nan if r["threshold"] is None else r["threshold"] for r in top], np.float64),
        tuple(None if r["categories"] is None else np.array(r["categories"]) for r in top),
        tuple(leaves),
        sum(leaf.value * float(np.prod(leaf.share)) for leaf in leaves),
    )


def load_trees(nodes: DataFrame) -> list[Tree]:
    """The trees of a node table. A model is as large as its nodes, whatever the rows; Spark's own models are sent to tasks like this."""
    rows = nodes.orderBy("tree", "node").collect()
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["tree"], []).append(r)
    return [_tree(t) for t in trees.values()]


def _leaf_share(leaf: Leaf, passes: np.ndarray) -> np.ndarray:
    """(patterns, features of the path): what each feature adds at this leaf. passes: (patterns, features), 0 or 1."""
    d = len(leaf.features)
    points, weights = np.polynomial.legendre.leggauss(d // 2 + 1)
    points, weights = (points + 1) / 2, weights / 2
    terms = leaf.share[None, None, :] * (1 - points)[:, None, None] + passes[None, :, :] * points[:, None, None]
    whole = terms.prod(2, keepdims=True)
    return leaf.value * (passes - leaf.share) * np.einsum("q,qpd->pd", weights, whole / terms)


def contributions(trees: Sequence[Tree], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, features) Shapley values of the weighted sum of trees, and the sum itself."""
    out, margin = np.zeros(x.shape), np.zeros(len(x))
    for tree in trees:
        left = tree.left(x)
        for leaf in tree.leaves:
            d = len(leaf.features)
            if not d:
                margin += leaf.value
                continue
            passes = np.ones((len(x), d), bool)
            for j, steps in enumerate(leaf.steps):
                for at, goes_left in steps:
                    passes[:, j] &= left[:, at] if goes_left else ~left[:, at]
            margin += leaf.value * passes.all(1)
            # rows that pass the same features have the same shares
            code = passes @ (1 << np.arange(d, dtype=np.int64)) if d < 63 else np.arange(len(x))
            _, one, which = np.unique(code, return_index=True, return_inverse=True)
            out[:, leaf.features] += _leaf_share(leaf, passes[one].astype(np.float64))[which]
    return out, margin


def tree_attribution(features: Column | str, trees: Sequence[Tree], size: int) -> Column:
    """struct(contributions ARRAY, margin, expected) of an ARRAY of feature values, in Arrow batches.

    contributions add up to margin - expected. Null for rows without features.
    """
    expected = float(sum(t.mean for t in trees))

    def run(column: pa.Array) -> pa.Array:
        given = column.is_valid().to_numpy(zero_copy_only=False)
        x = column.drop_null().flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        parts = [contributions(trees, x[a : a + ROWS]) for a in range(0, len(x), ROWS)]
        phi = np.concatenate([p for p, _ in parts]) if parts else np.zeros((0, size))
        margin = np.concatenate([m for _, m in parts]) if parts else np.zeros(0)
        at = np.where(given, np.cumsum(given) - 1, 0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(phi) + 1, dtype=np.int32) * size), pa.array(phi.ravel()))
        take = pa.array(at, mask=~given)
        found = [lists.take(take), pa.array(margin).take(take), pa.array(np.full(len(column), expected))]
        return pa.StructArray.from_arrays(found, ["contributions", "margin", "expected"], mask=pa.array(~given))

    kind = "contributions array<double>, margin double, expected double"
    return F.arrow_udf(run, kind)(features)


def attribute(df: DataFrame, model: Model, features_col: str = "features") -> DataFrame:
    """df with contributions ARRAY (one per feature of the vector), margin and expected, exact for every row.

    margin is the model's weighted sum of trees: for boosted classifiers the log-odds scale of rawPrediction, for other classifiers the
    probability of class 1. expected is its mean over the training rows that each tree counted. A row without a vector gets nulls;
    rows that repeat are computed again; columns with the new names are replaced.
    """
    trees = load_trees(node_table(model))
    size = model.numFeatures
    told = df.withColumn("__told", tree_attribution(vector_to_array(F.col(features_col)), trees, size))
    names = ("contributions", "margin", "expected")
    return told.select(*[c for c in df.columns if c not in names], *[F.col(f"__told.{n}").alias(n) for n in names])


def tree_importance(df: DataFrame, model: Model, names: Sequence[str], features_col: str = "features") -> DataFrame:
    """(feature, mean_abs_contribution, mean_contribution) over all rows with a vector. names: of the vector's places."""
    told = attribute(df.select(features_col), model, features_col)
    table = F.array(*[F.lit(n) for n in names])
    long = told.select(F.posexplode("contributions").alias("i", "phi"))
    summed = long.groupBy("i").agg(F.avg(F.abs("phi")).alias("mean_abs_contribution"), F.avg("phi").alias("mean_contribution"))
    return summed.select(F.get(table, F.col("i")).alias("feature"), "mean_abs_contribution", "mean_contribution")


@dataclass(frozen=True)
class Forest:
    """All trees of a model, node after node, for scoring many models in one pass over the rows."""

    root: np.ndarray
    weight: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    categories: dict[int, np.ndarray]

    def staged(self, x: np.ndarray, counts: Sequence[int]) -> np.ndarray:
        """(rows, counts): weighted sums of the first trees, for each of the counts (those beyond the last tree: all)."""
        at = np.broadcast_to(self.root, (len(x), len(self.root))).copy()
        row = np.arange(len(x))[:, None]
        while (inner := self.left[at] >= 0).any():
            goes_left = x[row, self.feature[at]] <= self.threshold[at]
            for node, categories in self.categories.items():
                here = at == node
                if here.any():
                    goes_left[here] = np.isin(x[np.nonzero(here)[0], self.feature[node]], categories)
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
        sums = np.concatenate([np.zeros((len(x), 1)), np.cumsum(self.value[at] * self.weight, 1)], 1)
        return sums[:, [min(c, len(self.root)) for c in counts]]


def load_forest(nodes: DataFrame) -> Forest:
    """The trees of a node table side by side; as large as the model."""
    rows = nodes.orderBy("tree", "node").collect()
    first: dict[int, int] = {}
    for i, r in enumerate(rows):
        first.setdefault(r["tree"], i)
    base = np.array([first[r["tree"]] for r in rows], np.int64)
    child = lambda c: np.array([r[c] for r in rows], np.int64)
    left, right = child("left"), child("right")
    return Forest(
        np.array(list(first.values()), np.int64),
        np.array([rows[i]["weight"] for i in first.values()], np.float64),
        np.where(left < 0, -1, left + base),
        np.where(left < 0, -1, right + base),
        np.array([r["feature"] or 0 for r in rows], np.int64),
        np.array([np.nan if r["threshold"] is None else r["threshold"] for r in rows], np.float64),
        np.array([r["value"] for r in rows], np.float64),
        {i: np.array(r["categories"]) for i, r in enumerate(rows) if r["categories"] is not None},
    )


def side_by_side(features: Column | str, which: Column | str, models: Sequence[Sequence[tuple[Forest, Sequence[int]]]]) -> Column:
    """ARRAY of sums for a row: of all models of the list that `which` names (from 0), for all their counts, one after the other.

    Null for rows without features or list. All models are scored in one pass, in Arrow batches.
    """

    def run(column: pa.Array, lists: pa.Array) -> pa.Array:
        given = column.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
        place = lists.fill_null(-1).to_numpy(zero_copy_only=False)
        out: list = [None] * len(column)
        for i, some in enumerate(models):
            rows = np.flatnonzero(given & (place == i))
            for a in range(0, len(rows), ROWS):
                part = rows[a : a + ROWS]
                x = column.take(pa.array(part)).flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
                x = x.reshape(len(part), -1)
                sums = np.concatenate([np.zeros((len(part), 0)), *[f.staged(x, counts) for f, counts in some]], 1)
                for r, values in zip(part.tolist(), sums, strict=True):
                    out[r] = values
        return pa.array(out, pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(features, which)
