"""Queries: statistics that leave one fold out, features fitted inside folds, exact tree attribution."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from driftloom.operators import encode, fold_fits, folds, metrics, trees
from driftloom.plans import features, halving, oof, search
from driftloom.session import durable
from workload.fixtures import MARKET_SQL, market
from workload.models import BOOSTED, FOREST, LOGISTIC, TEXT_FEATURES, _counted, _passengers, _texts
from workload.registry import load, query, r6

FOLDS = 5
OUTSIDE = f"fits AS (SELECT CAST(range AS INTEGER) AS fit FROM range({FOLDS}))"


def _folded(spark, sf):
    return market(spark, sf).withColumn("fold", (F.col("o_orderkey") % FOLDS).cast("int"))


@query(
    f"""WITH {MARKET_SQL}, {OUTSIDE}
    SELECT fit, c_mktsegment, 'o_totalprice' AS "column", count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 6) AS median
    FROM market JOIN fits ON o_orderkey % {FOLDS} <> fit GROUP BY fit, c_mktsegment"""
)
def fold_medians(spark, sf):
    found = fold_fits.leave_out_percentiles(_folded(spark, sf), ["o_totalprice"], [0.5], "fold", FOLDS, ["c_mktsegment"])
    return r6(found.select("fit", "c_mktsegment", "column", "n", F.col("quantiles")[0].alias("median")))


@query(
    f"""WITH {MARKET_SQL}, {OUTSIDE}
    SELECT fit, round(quantile_cont(c_acctbal, 0.25), 6) AS q1, round(quantile_cont(c_acctbal, 0.5), 6) AS q2, round(quantile_cont(c_acctbal, 0.75), 6) AS q3
    FROM market JOIN fits ON o_orderkey % {FOLDS} <> fit GROUP BY fit"""
)
def fold_quartiles(spark, sf):
    found = fold_fits.leave_out_percentiles(_folded(spark, sf), ["c_acctbal"], [0.25, 0.5, 0.75], "fold", FOLDS)
    return r6(found.select("fit", *[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(3)]))


@query(
    f"""WITH {MARKET_SQL}, {OUTSIDE}
    SELECT o_custkey, fit, count(*) AS n FROM market JOIN fits ON o_orderkey % {FOLDS} <> fit GROUP BY o_custkey, fit"""
)
def fold_frequencies(spark, sf):
    return fold_fits.leave_out_frequencies(_folded(spark, sf), "o_custkey", "fold", FOLDS)


@query(
    f"""WITH {MARKET_SQL}, {OUTSIDE}, long AS (
      SELECT o_orderkey, unnest(['o_orderpriority', 'c_mktsegment', 'n_name']) AS "column", unnest([o_orderpriority, c_mktsegment, n_name]) AS value FROM market
    ), counted AS (SELECT fit, "column", value, count(*) AS n FROM long JOIN fits ON o_orderkey % {FOLDS} <> fit GROUP BY ALL)
    SELECT fit, "column", value AS mode, n FROM counted QUALIFY row_number() OVER (PARTITION BY fit, "column" ORDER BY n DESC, value) = 1"""
)
def fold_modes(spark, sf):
    return fold_fits.leave_out_modes(_folded(spark, sf), ["o_orderpriority", "c_mktsegment", "n_name"], "fold", FOLDS)


@query(
    f"""WITH {MARKET_SQL}, {OUTSIDE}, pairs AS (
      SELECT a.fit, b.fit AS fold FROM fits a, fits b
    ), priors AS (
      SELECT p.fit, p.fold, avg(label) AS prior FROM market JOIN pairs p ON o_orderkey % {FOLDS} NOT IN (p.fit, p.fold) GROUP BY ALL
    ), long AS (
      SELECT o_orderkey, label, unnest(['o_orderpriority', 'n_name']) AS "column", unnest([o_orderpriority, n_name]) AS category FROM market
    ), cats AS (SELECT DISTINCT "column", category FROM long),
    rest AS (
      SELECT "column", category, p.fit, p.fold, count(*) AS n, sum(label) AS s FROM long JOIN pairs p ON o_orderkey % {FOLDS} NOT IN (p.fit, p.fold) GROUP BY ALL
    )
    SELECT "column", category, fit, fold, coalesce(n, 0)::BIGINT AS n, round((coalesce(s, 0) + 10 * prior) / (coalesce(n, 0) + 10), 6) AS encoding
    FROM cats CROSS JOIN priors LEFT JOIN rest USING ("column", category, fit, fold)"""
)
def fold_nested_encodings(spark, sf):
    found = fold_fits.nested_encodings(_folded(spark, sf), ["o_orderpriority", "n_name"], "label", "fold", None, FOLDS)
    return r6(found.select("column", "category", "fit", "fold", "n", "encoding"))


@query()
def features_inside_folds(spark, sf):
    """Every record once per left-out fold, with features fitted without it."""
    split = durable(folds.stratified_folds(_passengers(spark, sf), "Survived", "PassengerId", FOLDS))
    return r6(features.FeatureBuilder().fold_features(split, "fold", FOLDS)[1])


@query()
def inside_fold_areas(spark, sf):
    """ROC area per fold of models whose features were fitted without the fold."""
    split = durable(folds.stratified_folds(_passengers(spark, sf), "Survived", "PassengerId", FOLDS))
    columns, rows = features.FeatureBuilder().fold_features(split, "fold", FOLDS)
    keep = ["PassengerId", "Survived", "fold", "fit", "held"]
    rows = durable(features.ColumnSelector(columns, keep).transform(rows).drop(*columns), ["fit"])
    make = lambda: LOGISTIC.estimator(label="Survived")
    scores = oof.fitted_fold_scores(rows, make, FOLDS, ["Survived", "fold"])
    return r6(metrics.ranking_metrics(durable(scores), "Survived", "p", ["fold"]))


def _all_counted(spark, sf):
    return _counted(load(spark, sf, "documents"))


@query(
    """SELECT model, doc_id, true AS adds_up, 4 AS features FROM documents, (VALUES ('boosted'), ('forest')) AS m(model)"""
)
def tree_contributions_add_up(spark, sf):
    """Contributions of every document sum to the model's own margin minus its mean."""
    parts = []
    for learner in (BOOSTED, FOREST):
        model = learner.estimator().fit(_texts(spark, sf))
        told = trees.attribute(model.transform(_all_counted(spark, sf)), model)
        parts.append(_added_up(told, learner.name))
    return parts[0].unionByName(parts[1])


def _added_up(told, name):
    """Against the margin that the model itself tells."""
    own = vector_to_array("rawPrediction")[1] if name == "boosted" else vector_to_array("probability")[1]
    total = F.aggregate("contributions", F.lit(0.0), lambda s, x: s + x)
    same = (F.abs(total - (own - F.col("expected"))) < 1e-6) & (F.abs(own - F.col("margin")) < 1e-6)
    return told.select(F.lit(name).alias("model"), "doc_id", same.alias("adds_up"), F.size("contributions").alias("features"))


@query()
def tree_importance(spark, sf):
    """Mean size of each feature's exact contribution over all documents."""
    model = BOOSTED.estimator().fit(_texts(spark, sf))
    return r6(trees.tree_importance(_all_counted(spark, sf), model, TEXT_FEATURES))


@query(
    """WITH c AS (SELECT o_orderkey, o_custkey, CAST(o_custkey AS VARCHAR) AS v FROM orders),
    n AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT v FROM c))
    SELECT o_orderkey, (SELECT count(*) - 1 FROM n)::INTEGER AS size, CASE WHEN i > 0 THEN i - 1 END::INTEGER AS place FROM c JOIN n USING (v)"""
)
def wide_category_flags(spark, sf):
    """A column with a category for every customer, as one sparse vector: its size, and the place of its only 1."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    index = durable(encode.category_index(orders, "o_custkey"))
    flags = encode.sparse_flags(orders, index, "o_custkey", encode.flag_encoder("o_custkey", index.count()))
    vector = F.unwrap_udt("o_custkey_flags")
    return flags.select("o_orderkey", vector["size"].alias("size"), F.get(vector["indices"], F.lit(0)).alias("place"))


@query("SELECT * FROM (VALUES (0, 8, 9, 3), (1, 24, 3, 1), (2, 72, 1, 1)) AS t(rung, trees, trials, survivors)")
def halving_rungs(spark, sf):
    """Trials, trees and survivors of each rung of a search over the full spaces."""
    table = halving_search(spark, sf)
    return table.groupBy("rung").agg(
        F.max("trees").alias("trees"), F.count(F.lit(1)).alias("trials"), F.count_if("survives").alias("survivors")
    )


@query()
def halving_search(spark, sf):
    how = halving.Halving((8, 24, 72), 1 / 3, 4)
    return r6(halving.successive_halving(_texts(spark, sf), "label", "fold", 3, search.draw_trials(9), how))
