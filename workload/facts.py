"""Queries on models and saved artefacts whose results SQL can tell: coverage, agreement, constants, saved tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from driftloom.operators import contract, drift, encode, folds, parse, scoring
from driftloom.plans import features, imputer, oof, stacking
from driftloom.session import durable, durable_dir
from workload import tabular  # noqa: F401  registers the SQL that is used again here
from workload.evaluation import NUMERIC, _flag_sides
from workload.fixtures import MARKET_SQL, gaps, halves, market
from workload.models import FOREST, LOGISTIC, _counted, _passengers, _texts
from workload.registry import ORACLES, load, query, r6

LABELLED_SQL = "FROM documents JOIN labels USING (doc_id)"


def _folder(spark) -> str:
    return f"{durable_dir(spark)}/{uuid.uuid4().hex}"


@query(
    f"""WITH f AS (SELECT quality, (row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1) % 3 AS fold {LABELLED_SQL})
    SELECT CAST(fold AS INTEGER) AS fold, quality AS label, count(*) AS n, count(*) AS ids, count(*) AS scored FROM f GROUP BY ALL"""
)
def oof_coverage(spark, sf):
    """Every labelled row is scored once, in its own fold."""
    docs = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    rows = _counted(docs, F.col("quality").alias("label"))
    rows = durable(folds.stratified_folds(rows, "label", "doc_id", 3, seed=None))
    scores = oof.out_of_fold(rows, lambda: LOGISTIC.estimator(), "fold", 3, ["doc_id", "label"])
    return scores.groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("doc_id").alias("ids"),
        F.count_if((F.col("p") >= 0) & (F.col("p") <= 1)).alias("scored"),
    )


@query(f"SELECT doc_id, true AS agrees {LABELLED_SQL}")
def voting_is_the_weighted_mean(spark, sf):
    rows = _texts(spark, sf)
    model = stacking.VotingEstimator([LOGISTIC, FOREST], [1.5, 1.1]).fit(rows)
    voted = model.transform(rows).select("doc_id", scoring.positive_probability().alias("vote"))
    for name, learner in (("a", LOGISTIC), ("b", FOREST)):
        part = learner.estimator().fit(rows).transform(rows).select("doc_id", scoring.positive_probability().alias(name))
        voted = voted.join(part, "doc_id")
    mean = (1.5 * F.col("a") + 1.1 * F.col("b")) / 2.6
    return voted.select("doc_id", (F.abs(mean - F.col("vote")) < 1e-9).alias("agrees"))


@query(ORACLES["impute_mean"])
def imputer_saved(spark, sf):
    """Fitted, saved, loaded, then used."""
    df = gaps(spark, sf).select("o_orderkey", "x1", "x2")
    path = _folder(spark)
    imputer.MissingImputer(["x1", "x2"], "mean", id_col="o_orderkey", diagnose=False).fit(df).write().save(path)
    return r6(imputer.MissingImputerModel.load(path).transform(df).select("o_orderkey", "x1", "x2"))


@query(
    f"""WITH {MARKET_SQL}, r AS (SELECT o_orderkey, CAST(o_totalprice / (family + family % 3 + 1) * 10000 AS DECIMAL(30, 6)) AS x FROM market),
    w AS (SELECT o_orderkey, x, CAST(floor(x) AS BIGINT) AS f FROM r)
    SELECT o_orderkey, (CASE WHEN x - f < 0.5 THEN f WHEN x - f > 0.5 THEN f + 1 ELSE f + f % 2 END) / 10000.0::DOUBLE AS price_per_person FROM w"""
)
def ratio_half_even(spark, sf):
    df = market(spark, sf).withColumn("family_size", parse.family_size("family", F.col("family") % 3))
    return df.select("o_orderkey", parse.rounded_ratio("o_totalprice", "family_size").alias("price_per_person"))


@query("SELECT 'orders' AS batch, count(*) AS n, count(*) = 0 AS refused FROM orders UNION ALL SELECT 'none', 0, true")
def guarded_batches(spark, sf):
    orders = load(spark, sf, "orders")
    lines = []
    for name, batch in (("orders", orders), ("none", orders.limit(0))):
        try:
            lines.append((name, contract.refuse_empty(batch).count(), False))
        except ValueError:
            lines.append((name, 0, True))
    return spark.createDataFrame(lines, "batch string, n long, refused boolean")


@query("SELECT CAST(c_custkey AS INTEGER) AS PassengerId, CAST(0.3838 AS DOUBLE) AS title, CAST(0.3838 AS DOUBLE) AS ticket FROM customer")
def constant_prior(spark, sf):
    """Without a label every encoding is the default prior."""
    records = _passengers(spark, sf).drop("Survived")
    out = features.FeatureBuilder(label=None).fit(records).transform(records)
    return out.select("PassengerId", F.col("Title_TE").alias("title"), F.col("TicketPrefix_TE").alias("ticket"))


@query(
    """SELECT c_custkey % 50 AS id, CAST((c_custkey % 5 IN (0, 2) AND c_custkey % 11 <> 0) OR c_custkey % 13 = 0 AS INTEGER) AS label,
    count(*) AS n FROM customer GROUP BY ALL"""
)
def repeated_ids_keep_their_rows(spark, sf):
    """Records that share ids: as many training rows as records, with their labels."""
    records = _passengers(spark, sf).withColumn("PassengerId", F.col("PassengerId") % 50)
    _, rows = features.FeatureBuilder().fit_transform(records)
    kept = rows.select(F.col("PassengerId").cast("long").alias("id"), F.col("Survived").alias("label"))
    return kept.groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))


def _saved(spark, reference, cols=None):
    path = _folder(spark)
    drift.fit_reference(reference, cols).save(path)
    return drift.load_reference(spark, path)


def _pair_saved(spark, sf):
    reference, current = halves(spark, sf)
    moved = current.withColumn("l_extendedprice", F.col("l_extendedprice") * 1.5)
    return drift.pair_with(_saved(spark, reference, NUMERIC), moved)


@query(ORACLES["psi_all"])
def psi_saved_reference(spark, sf):
    return r6(drift.numeric_statistics(_pair_saved(spark, sf)).select("column", "psi"))


@query(ORACLES["ks_w1_all"])
def ks_w1_saved_reference(spark, sf):
    found = drift.numeric_statistics(_pair_saved(spark, sf))
    return found.select(
        "column", "n_ref", "n_cur", F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("wasserstein_distance", 4).alias("wasserstein_distance"),
    )


@query(ORACLES["tvd_chi2_all"])
def tvd_chi2_saved_reference(spark, sf):
    reference, current = _flag_sides(spark, sf)
    pair = drift.pair_with(_saved(spark, reference), current)
    found = drift.category_distances(drift.category_counts(pair), pair)
    return found.withColumns({"tvd": F.round("tvd", 6), "statistic": F.round("statistic", 4), "unseen_share": F.round("unseen_share", 6)})


@query(
    """WITH c AS (SELECT o_clerk, row_number() OVER (ORDER BY o_clerk) - 1 AS i FROM (SELECT DISTINCT o_custkey::VARCHAR AS o_clerk FROM orders WHERE o_orderkey % 3 <> 0))
    SELECT o_orderkey, coalesce(i, -1) AS o_custkey_index FROM orders LEFT JOIN c ON o_custkey::VARCHAR = o_clerk"""
)
def category_numbers(spark, sf):
    """A column with very many values, numbered at fit on two thirds of the rows."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    table = encode.category_index(orders.where("o_orderkey % 3 <> 0"), "o_custkey")
    return encode.apply_category_index(orders, table, "o_custkey").select("o_orderkey", "o_custkey_index")
