"""Queries: drift, folds, metrics, blending, governance, attribution, scoring tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftloom.operators import attribution, drift, eda, ensemble, folds, governance, metrics, scoring
from workload.fixtures import SCORED_SQL, halves, scored
from workload.registry import load, query, r6

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
SPLIT = "l_shipdate < TIMESTAMP '1998-01-01'"

SIDES_SQL = (
    "sides AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} * (CASE WHEN '{c}' = 'l_extendedprice' AND NOT ({SPLIT}) THEN 1.5 ELSE 1 END) AS v, "
        f"{SPLIT} AS is_ref FROM lineitem"
        for c in NUMERIC
    )
    + ")"
)


def _numeric_sides(spark, sf):
    reference, current = halves(spark, sf)
    moved = current.withColumn("l_extendedprice", F.col("l_extendedprice") * 1.5)
    return drift.pair_up(reference, moved, NUMERIC)


@query(
    f"""WITH {SIDES_SQL},
    n AS (SELECT col, count(*) FILTER (is_ref) AS nr, count(*) FILTER (NOT is_ref) AS nc FROM sides GROUP BY col),
    e AS (SELECT col, list_distinct(quantile_cont(v, [0,.1,.2,.3,.4,.5,.6,.7,.8,.9,1])) AS edges
          FROM sides WHERE is_ref GROUP BY col),
    inner_edges AS (SELECT col, len(edges) AS k, unnest(list_sort(edges)[2:-2]) AS edge FROM e),
    binned AS (SELECT s.col, s.is_ref, (SELECT count(*) FROM inner_edges i WHERE i.col = s.col AND i.edge <= s.v) AS bin
               FROM sides s),
    c AS (SELECT col, bin, count(*) FILTER (is_ref) AS cr, count(*) FILTER (NOT is_ref) AS cc FROM binned GROUP BY 1, 2),
    p AS (SELECT c.col, (cr / nr + 1e-4) / (1 + 1e-4 * (len(edges) - 1)) AS r, (cc / nc + 1e-4) / (1 + 1e-4 * (len(edges) - 1)) AS q
          FROM c JOIN n USING (col) JOIN e USING (col))
    SELECT col AS "column", round(least(greatest(sum((q - r) * ln(q / r)), 0), 10), 6) AS psi FROM p GROUP BY col"""
)
def psi_all(spark, sf):
    return r6(drift.numeric_statistics(_numeric_sides(spark, sf)).select("column", "psi"))


@query(
    f"""WITH {SIDES_SQL},
    v AS (SELECT col, v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM sides GROUP BY 1, 2),
    t AS (SELECT col, sum(r) AS nr, sum(c) AS nc FROM v GROUP BY 1),
    f AS (SELECT col, v, abs(sum(r) OVER w / nr - sum(c) OVER w / nc) AS gap, lead(v) OVER w - v AS step, nr, nc
          FROM v JOIN t USING (col) WINDOW w AS (PARTITION BY col ORDER BY v))
    SELECT col AS "column", CAST(any_value(nr) AS BIGINT) AS n_ref, CAST(any_value(nc) AS BIGINT) AS n_cur,
      round(max(gap), 6) AS ks_statistic, round(sum(gap * step), 4) AS wasserstein_distance FROM f GROUP BY col"""
)
def ks_w1_all(spark, sf):
    found = drift.numeric_statistics(_numeric_sides(spark, sf))
    return found.select(
        "column", "n_ref", "n_cur", F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("wasserstein_distance", 4).alias("wasserstein_distance"),
    )


FLAGS_SQL = f"""
flags AS (
  SELECT 'l_returnflag' AS col, CASE WHEN NOT ({SPLIT}) AND l_orderkey % 50 = 0 THEN 'Z' ELSE l_returnflag END AS cat,
         {SPLIT} AS is_ref FROM lineitem WHERE {SPLIT} OR NOT (l_returnflag = 'N' AND l_orderkey % 2 = 0)
  UNION ALL
  SELECT 'l_linestatus', CASE WHEN l_orderkey % 17 <> 0 THEN l_linestatus END, {SPLIT} FROM lineitem
  WHERE {SPLIT} OR NOT (l_returnflag = 'N' AND l_orderkey % 2 = 0)),
sizes AS (SELECT col, count(*) FILTER (is_ref) AS nr, count(*) FILTER (NOT is_ref) AS nc FROM flags GROUP BY col),
cats AS (SELECT col, cat, count(*) FILTER (is_ref) AS cr, count(*) FILTER (NOT is_ref) AS cc FROM flags GROUP BY 1, 2)
"""


def _flag_sides(spark, sf):
    def shape(df, current):
        k = F.col("l_orderkey")
        flag = F.col("l_returnflag")
        if current:
            df = df.where(~((flag == "N") & (k % 2 == 0)))
            flag = F.when(k % 50 == 0, "Z").otherwise(flag)
        return df.select(flag.alias("l_returnflag"), F.when(k % 17 != 0, F.col("l_linestatus")).alias("l_linestatus"))

    reference, current = halves(spark, sf)
    return shape(reference, False), shape(current, True)


@query(
    f"""WITH {FLAGS_SQL} SELECT col AS "column", CAST(any_value(nr) AS BIGINT) AS n_ref,
    CAST(any_value(nc) AS BIGINT) AS n_cur, round(0.5 * sum(abs(cc / nc - cr / nr)), 6) AS tvd,
    round(sum((cc - cr / nr * nc) ** 2 / (cr / nr * nc)) FILTER (cr > 0), 4) AS statistic,
    CAST(count(*) FILTER (cr > 0) - 1 AS BIGINT) AS dof,
    round(coalesce(sum(cc) FILTER (cr = 0), 0) / any_value(nc), 6) AS unseen_share
    FROM cats JOIN sizes USING (col) GROUP BY col"""
)
def tvd_chi2_all(spark, sf):
    pair = drift.pair_up(*_flag_sides(spark, sf))
    found = drift.category_distances(drift.category_counts(pair), pair)
    return found.withColumns({"tvd": F.round("tvd", 6), "statistic": F.round("statistic", 4), "unseen_share": F.round("unseen_share", 6)})


@query(
    f"""WITH {FLAGS_SQL} SELECT col AS "column", cat AS category, cc AS n FROM cats WHERE cr = 0 AND cc > 0"""
)
def unseen_categories(spark, sf):
    reference, current = _flag_sides(spark, sf)
    return drift.unseen_categories(reference, current, ["l_returnflag", "l_linestatus"])


@query()
def drift_report(spark, sf):
    reference, current = halves(spark, sf)
    return drift.drift_report(reference, current, [*NUMERIC, "l_tax", "l_returnflag", "l_linestatus"])


@query()
def drift_summary(spark, sf):
    reference, current = halves(spark, sf)
    moved = current.withColumn("l_extendedprice", F.col("l_extendedprice") * 1.5)
    pair = drift.pair_up(reference, moved, [*NUMERIC, "l_returnflag"])
    return drift.drift_summary(drift.drift_report(reference, moved, pair=pair), pair)


@query()
def drift_display(spark, sf):
    reference, current = halves(spark, sf)
    return drift.display_table(drift.drift_report(reference, current, ["l_quantity", "l_returnflag"]))


def _scored_halves(spark, sf):
    def shape(df, cut):
        p = F.least(F.lit(0.999), F.col("l_quantity") / 51)
        return df.select(p.alias("probability"), (p >= cut).cast("int").alias("prediction"))

    reference, current = halves(spark, sf)
    return shape(reference, 0.5), shape(current, 0.6)


@query(
    f"""WITH s AS (SELECT {SPLIT} AS is_ref, least(CAST(0.999 AS DOUBLE), l_quantity / 51) AS p FROM lineitem),
    d AS (SELECT is_ref, CASE WHEN p >= (CASE WHEN is_ref THEN 0.5 ELSE 0.6 END) THEN 1.0 ELSE 0.0 END AS y FROM s),
    m AS (SELECT avg(y) FILTER (is_ref) AS r, avg(y) FILTER (NOT is_ref) AS c, count(*) FILTER (NOT is_ref) AS nc FROM d)
    SELECT round(abs(c - r), 4) AS tvd, round(nc * (c - r) ** 2 / r + nc * (c - r) ** 2 / (1 - r), 2) AS statistic,
    abs(c - r) >= 0.10 AS class_drift, round(r, 4) AS reference_positive_rate, round(c, 4) AS current_positive_rate FROM m"""
)
def pred_drift_rates(spark, sf):
    found = drift.class_shift(*_scored_halves(spark, sf))
    return found.select(
        "tvd", F.round("statistic", 2).alias("statistic"), "class_drift", "reference_positive_rate", "current_positive_rate"
    )


@query()
def prediction_drift(spark, sf):
    return drift.prediction_drift(*_scored_halves(spark, sf))


@query(
    """SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 5
    AS INTEGER) AS fold FROM orders"""
)
def stratified_folds(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return folds.stratified_folds(orders, "o_orderstatus", "o_orderkey", 5, seed=None)


@query(
    """SELECT o_orderstatus, 5 AS folds, count(*) AS n, 0 AS uneven FROM orders GROUP BY 1"""
)
def stratified_folds_shuffled(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    assigned = folds.stratified_folds(orders, "o_orderstatus", "o_orderkey", 5, seed=42)
    per_fold = assigned.groupBy("o_orderstatus", "fold").agg(F.count(F.lit(1)).alias("k"))
    return per_fold.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).cast("int").alias("folds"),
        F.sum("k").alias("n"),
        (F.max("k") - F.min("k") > 1).cast("int").alias("uneven"),
    )


AREA_SQL = """
v AS (SELECT fold, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY fold ORDER BY score DESC) AS fp,
             sum(pos) OVER (PARTITION BY fold) AS p, sum(neg) OVER (PARTITION BY fold) AS n FROM v)
"""


@query(
    f"""WITH {SCORED_SQL}, {AREA_SQL} SELECT fold, CAST(any_value(p) AS BIGINT) AS n_pos, CAST(any_value(n) AS BIGINT) AS n_neg,
    round(sum(pos * (below + neg / 2.0)) / (any_value(p) * CAST(any_value(n) AS DOUBLE)), 6) AS auc,
    round(sum(pos * tp / (tp + fp)) / any_value(p), 6) AS pr_auc FROM w GROUP BY fold"""
)
def auc_by_fold(spark, sf):
    return r6(metrics.ranking_metrics(scored(spark, sf), "label", "score", ["fold"]))


@query(
    f"""WITH {SCORED_SQL.replace('l_orderkey % 5 AS fold', '0 AS fold')}, {AREA_SQL}
    SELECT round(sum(pos * (below + neg / 2.0)) / (any_value(p) * CAST(any_value(n) AS DOUBLE)), 6) AS auc FROM w"""
)
def auc_exact(spark, sf):
    return r6(metrics.ranking_metrics(scored(spark, sf), "label", "score").select("auc"))


@query(
    f"""WITH {SCORED_SQL.replace('l_orderkey % 5 AS fold', '0 AS fold')}, {AREA_SQL}
    SELECT round(sum(pos * tp / (tp + fp)) / any_value(p), 6) AS pr_auc FROM w"""
)
def pr_auc(spark, sf):
    return r6(metrics.ranking_metrics(scored(spark, sf), "label", "score").select("pr_auc"))


@query(f"WITH {SCORED_SQL} SELECT label, CAST(score >= 0.5 AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY 1, 2")
def confusion(spark, sf):
    df = scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return metrics.confusion(df, "label", "prediction")


RATES_SQL = """
round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
round(2 * tp / (2 * tp + fp + fn), 6) AS f1_binary,
round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6) AS f1_macro,
round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy
"""


@query(
    f"""WITH {SCORED_SQL}, c AS (SELECT fold, count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
    count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn,
    count(*) FILTER (label = 0 AND score < 0.5) AS tn FROM scored GROUP BY fold)
    SELECT fold, tp, fp, fn, tn, {RATES_SQL} FROM c"""
)
def confusion_metrics(spark, sf):
    df = scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return r6(metrics.classification_metrics(df, "label", "prediction", ["fold"]))


def _sweep_sql(points, by="") -> str:
    keys = f"{by}, " if by else ""
    values = ", ".join(f"({i}, CAST({t!r} AS DOUBLE))" for i, t in enumerate(points))
    return f"""grid(idx, threshold) AS (VALUES {values}),
    c AS (SELECT {keys}idx, threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
      count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn,
      count(*) FILTER (label = 0 AND score < threshold) AS tn
      FROM scored, grid GROUP BY {keys}idx, threshold),
    g AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
      coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_binary,
      (coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2 AS f1_macro,
      (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fn) - fp / (fp + tn) AS youden_j FROM c)"""


WIDE = metrics.grid(*metrics.WIDE_GRID)
NARROW = metrics.grid(*metrics.NARROW_GRID)


@query(
    f"""WITH {SCORED_SQL}, {_sweep_sql(NARROW)} SELECT idx, round(threshold, 6) AS threshold, tp, fp, fn, tn,
    round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_binary, 6) AS f1_binary,
    round(f1_macro, 6) AS f1_macro, round(accuracy, 6) AS accuracy, round(youden_j, 6) + 0.0 AS youden_j FROM g"""
)
def threshold_sweep(spark, sf):
    return r6(metrics.threshold_sweep(scored(spark, sf), "label", "score", NARROW))


@query(
    f"""WITH {SCORED_SQL}, {_sweep_sql(WIDE)} SELECT round(threshold, 6) AS threshold, round(f1_macro, 6) AS f1_macro,
    round(accuracy, 6) AS accuracy FROM g ORDER BY round(g.f1_macro, 5) DESC, idx LIMIT 1"""
)
def best_threshold(spark, sf):
    sweep = metrics.threshold_sweep(scored(spark, sf), "label", "score", WIDE)
    return r6(metrics.best_threshold(sweep).select("threshold", "f1_macro", "accuracy"))


@query(
    f"""WITH {SCORED_SQL}, {_sweep_sql(WIDE)} SELECT 'youden' AS rule, round(threshold, 6) AS threshold FROM
      (SELECT * FROM g ORDER BY round(g.youden_j, 5) DESC, idx LIMIT 1) UNION ALL
    SELECT 'cost', round(threshold, 6) FROM (SELECT * FROM g ORDER BY g.fp * 1.0 + g.fn * 5.0, idx LIMIT 1)"""
)
def youden_and_cost(spark, sf):
    sweep = metrics.with_cost(metrics.threshold_sweep(scored(spark, sf), "label", "score", WIDE), 1.0, 5.0)
    youden = metrics.best_threshold(sweep, "youden_j").select(F.lit("youden").alias("rule"), "threshold")
    cost = metrics.best_threshold(sweep, "cost", least=True).select(F.lit("cost").alias("rule"), "threshold")
    return r6(youden.unionByName(cost))


@query(
    f"""WITH {SCORED_SQL}, {_sweep_sql(NARROW, 'fold')}, {AREA_SQL},
    b AS (SELECT fold, round(threshold, 3) AS t, row_number() OVER (PARTITION BY fold ORDER BY round(g.f1_macro, 5) DESC, idx) AS k FROM g),
    a AS (SELECT fold, sum(pos * (below + neg / 2.0)) / (any_value(p) * CAST(any_value(n) AS DOUBLE)) AS auc FROM w GROUP BY fold)
    SELECT round(avg(t), 3) AS mean_optimal_threshold, round(stddev_pop(t), 4) AS std_threshold,
    round(avg(auc), 6) AS mean_cv_auc, count(*) AS folds FROM b JOIN a USING (fold) WHERE k = 1"""
)
def cv_threshold(spark, sf):
    return metrics.cross_validated_threshold(scored(spark, sf), "label", "score", "fold")


@query(f"WITH {SCORED_SQL} SELECT fold, round(avg((score - label) ** 2), 6) AS brier FROM scored GROUP BY fold")
def brier(spark, sf):
    return r6(metrics.brier(scored(spark, sf), "label", "score", ["fold"]))


@query(
    f"""WITH {SCORED_SQL} SELECT CAST((score >= 0.1)::INT + (score >= 0.2)::INT + (score >= 0.3)::INT + (score >= 0.4)::INT
      + (score >= 0.5)::INT + (score >= 0.6)::INT + (score >= 0.7)::INT + (score >= 0.8)::INT + (score >= 0.9)::INT AS INTEGER) AS bin,
    count(*) AS n, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS positive_rate FROM scored GROUP BY 1"""
)
def reliability(spark, sf):
    return r6(metrics.reliability(scored(spark, sf), "label", "score"))


@query(f"WITH {SCORED_SQL} SELECT fold, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM scored GROUP BY fold")
def fold_moments(spark, sf):
    return r6(eda.moments(scored(spark, sf), "score", ["fold"]))


@query(
    f"""WITH {SCORED_SQL} SELECT l_orderkey, l_linenumber, round((score + score2 + score3) / 3, 6) AS equal_vote,
    round((1.5 * score + 1.4 * score2 + 1.1 * score3) / 4.0, 6) AS weighted_vote FROM scored"""
)
def soft_vote(spark, sf):
    names = ["score", "score2", "score3"]
    return r6(
        scored(spark, sf).select(
            "l_orderkey",
            "l_linenumber",
            ensemble.soft_vote(names).alias("equal_vote"),
            ensemble.soft_vote(names, [1.5, 1.4, 1.1]).alias("weighted_vote"),
        )
    )


DIMENSIONS = 64
WEIGHTS = {f"e{i}": (i * 37 % 41 - 20) / 10 for i in range(1, DIMENSIONS + 1)}


@query(
    "WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, 65)) AS i FROM embeddings), "
    "m AS (SELECT i, avg(x) AS m FROM e GROUP BY i) "
    "SELECT 'e' || i AS feature, round(avg(abs((i * 37 % 41 - 20) / 10 * (x - m))), 6) AS mean_abs_contribution "
    "FROM e JOIN m USING (i) GROUP BY i"
)
def linear_attribution(spark, sf):
    vectors = load(spark, sf, "embeddings")
    dims = vectors.select(*[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(DIMENSIONS)])
    return r6(attribution.linear_attribution(dims, WEIGHTS))


REGISTRY_SQL = """
r AS (SELECT event_id AS version, CAST(0.85 AS DOUBLE) + (event_id * 37 % 61) / 1000.0 AS auc FROM events),
b AS (SELECT *, max(auc) FILTER (auc >= 0.88) OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM r),
h AS (SELECT *, auc >= 0.88 AND auc > coalesce(prior, -1) AS won FROM b),
k AS (SELECT *, last_value(CASE WHEN won THEN version END IGNORE NULLS)
        OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h)
"""


def _versions(spark, sf):
    return load(spark, sf, "events").select(
        F.col("event_id").alias("version"), (F.lit(0.85) + (F.col("event_id") * 37 % 61) / 1000.0).alias("auc")
    )


@query(
    f"""WITH {REGISTRY_SQL} SELECT version, round(auc, 6) AS auc, won AS is_champion,
    CASE WHEN won THEN 'promoted_to_champion' ELSE 'registered_as_challenger' END AS status,
    CASE WHEN won THEN before END AS previous_champion, CASE WHEN won THEN version ELSE before END AS champion_now,
    round(CASE WHEN won THEN auc ELSE coalesce(prior, 0) END, 6) AS champion_auc FROM k"""
)
def promote_history(spark, sf):
    return r6(governance.promotion_history(_versions(spark, sf)))


@query(
    f"""WITH {REGISTRY_SQL} SELECT max(version) FILTER (won) AS champion,
    arg_max(before, version) FILTER (won) AS previous_champion, max(version) FILTER (NOT won) AS challenger FROM k"""
)
def registry_aliases(spark, sf):
    return governance.aliases(governance.promotion_history(_versions(spark, sf)))


GATE = (("accuracy", ">=", 0.6), ("f1_macro", ">=", 0.99), ("mean_latency_ms", "<=", 200.0), ("p95_latency_ms", "<=", 250.0), ("roc_auc", ">=", 0.5))
GATE_SQL = f"""{SCORED_SQL.replace('l_orderkey % 5 AS fold', '0 AS fold')}, {AREA_SQL},
    c AS (SELECT count(*) FILTER (label = 1 AND score >= 0.5) AS tp, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
      count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 0 AND score < 0.5) AS tn FROM scored),
    m AS (SELECT 'accuracy' AS metric, (tp + tn) / (tp + fp + fn + tn) AS value FROM c
      UNION ALL SELECT 'f1_macro', (2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2 FROM c
      UNION ALL SELECT 'roc_auc', sum(pos * (below + neg / 2.0)) / (any_value(p) * CAST(any_value(n) AS DOUBLE)) FROM w
      UNION ALL SELECT 'mean_latency_ms', avg(value) FROM events
      UNION ALL SELECT 'p95_latency_ms', quantile_cont(value, 0.95) FROM events),
    l(metric, op, "limit") AS (VALUES {', '.join(f"('{m}', '{o}', CAST({v} AS DOUBLE))" for m, o, v in GATE)}),
    g AS (SELECT metric, op, "limit", round(value, 4) AS actual,
      coalesce(CASE WHEN op = '>=' THEN value >= "limit" ELSE value <= "limit" END, false) AS passed FROM l LEFT JOIN m USING (metric))"""


@query(f"WITH {GATE_SQL} SELECT * FROM g")
def quality_gate(spark, sf):
    df = scored(spark, sf)
    hits = df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    rates = metrics.classification_metrics(hits, "label", "prediction").select("accuracy", "f1_macro")
    area = metrics.ranking_metrics(df, "label", "score").select(F.col("auc").alias("roc_auc"))
    latency = eda.latency_summary(load(spark, sf, "events"), "value")
    times = latency.select(F.col("mean_ms").alias("mean_latency_ms"), F.col("p95_ms").alias("p95_latency_ms"))
    values = eda.melt(rates, [], rates.columns).unionByName(eda.melt(area, [], area.columns))
    return governance.quality_gate(values.unionByName(eda.melt(times, [], times.columns)), GATE)


@query(f"WITH {GATE_SQL} SELECT CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS status, count(*) AS checks, count(*) FILTER (NOT passed) AS failed FROM g")
def gate_status(spark, sf):
    return governance.gate_status(quality_gate(spark, sf))


HOLES_SQL = """holes AS (SELECT l_orderkey // 2 AS id, CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN 'nan'::DOUBLE
    ELSE score END AS p FROM scored)"""


@query(
    f"""WITH {SCORED_SQL}, {HOLES_SQL}, h AS (SELECT id, CASE WHEN NOT isnan(p) THEN p END AS p FROM holes)
    SELECT id, CAST(p >= 0.34 AS INTEGER) AS prediction, round(p, 4) AS probability,
    CASE WHEN p >= 0.34 THEN 'Survived' WHEN p < 0.34 THEN 'Did Not Survive' END AS status,
    CASE WHEN p >= 0.7 THEN 'High' WHEN p >= 0.4 THEN 'Moderate' WHEN p < 0.4 THEN 'Low' END AS risk_level FROM h"""
)
def decisions_without_score(spark, sf):
    key = F.col("l_orderkey")
    p = F.when(key % 7 != 0, F.when(key % 11 == 0, F.lit(float("nan"))).otherwise(F.col("score")))
    return scoring.decide(scored(spark, sf).select(F.floor(key / 2).alias("id"), p.alias("p")), "id", "p", 0.34)


@query(
    f"""WITH {SCORED_SQL} SELECT l_orderkey AS id, CAST(score >= 0.34 AS INTEGER) AS prediction, round(score, 4) AS probability,
    CASE WHEN score >= 0.34 THEN 'Survived' ELSE 'Did Not Survive' END AS status,
    CASE WHEN score >= 0.7 THEN 'High' WHEN score >= 0.4 THEN 'Moderate' ELSE 'Low' END AS risk_level FROM scored"""
)
def decisions(spark, sf):
    return scoring.decide(scored(spark, sf), "l_orderkey", "score", 0.34)


@query(f"WITH {SCORED_SQL} SELECT count(*) AS total_samples, round(avg(CAST(score >= 0.34 AS INTEGER)), 4) AS positive_rate FROM scored")
def batch_summary(spark, sf):
    return scoring.batch_summary(scoring.decide(scored(spark, sf), "l_orderkey", "score", 0.34))


@query(
    """WITH p AS (SELECT event_id, ts, value / (value + 20) AS p FROM events),
    r AS (SELECT * FROM p ORDER BY ts DESC, event_id DESC LIMIT 2000)
    SELECT (SELECT count(*) FROM p) AS total_inferences, count(*) AS current_buffer_size, round(avg(p), 4) AS average_probability,
    round(avg(CAST(p >= 0.39 AS INTEGER)), 4) AS positive_prediction_rate, CAST(0.39 AS DOUBLE) AS optimal_threshold,
    'HEALTHY_OPERATIONAL' AS buffer_status FROM r"""
)
def last_n_metrics(spark, sf):
    p = F.col("value") / (F.col("value") + 20)
    events = load(spark, sf, "events").select("event_id", "ts", p.alias("probability"), (p >= 0.39).cast("int").alias("prediction"))
    return scoring.inference_metrics(events, ["ts", "event_id"], 0.39)


