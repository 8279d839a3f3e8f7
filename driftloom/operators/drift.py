"""Data and prediction drift between a reference and a current table, for all columns at once."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.functions.columns import NUMERIC, bucket_index, col, lookup, nan_to_null, p_value_text
from driftloom.functions.tails import chi2_p, ks_p
from driftloom.operators import ecdf
from driftloom.operators.missing import is_missing
from driftloom.session import durable
from driftloom.specs import DriftLimits

SIDE = "__is_ref"
LIMITS = DriftLimits()

@dataclass(frozen=True)
class Pair:
    """Both sides in one frame, with the shared columns and the row and missing counts of each side.

    `values` holds the value counts of the numeric columns: (column, bucket, value, n_ref, n_cur). With a fitted
    reference, `rows` holds the current side only, and its category counts and PSI edges come along.
    """

    rows: DataFrame
    numeric: list[str]
    categorical: list[str]
    values: DataFrame | None
    counts: dict[str, int]
    categories: DataFrame | None = None
    edges: dict[str, list[float]] | None = None

    def present(self, side: str, c: str) -> int:
        return self.counts[f"{side}_rows"] - self.counts[f"{side}_missing_{c}"]


def common_columns(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> list[str]:
    wanted = reference.columns if features is None else features
    return [c for c in wanted if c in reference.columns and c in current.columns]


def pair_up(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    rows_per_bucket: int = ecdf.ROWS_PER_BUCKET,
) -> Pair:
    """Stack the two sides, look at them once (split points, row and missing counts), and count values.

    A column is numeric or categorical by the type it has in the reference. The value counts are
    written to the durable folder, since the edges and the distances both start from them.
    """
    cols = common_columns(reference, current, features)
    numeric = [c for c in cols if isinstance(reference.schema[c].dataType, NUMERIC)]
    categorical = [c for c in cols if c not in numeric]

    def side(df: DataFrame, is_ref: bool) -> DataFrame:
        cells = [F.col(c).cast("double" if c in numeric else "string").alias(c) for c in cols]
        return df.select(F.lit(is_ref).alias(SIDE), *cells)

    rows = side(reference, True).unionAll(side(current, False))
    extras = {}
    for name, on in (("ref", F.col(SIDE)), ("cur", ~F.col(SIDE))):
        extras[f"{name}_rows"] = F.count_if(on)
        for c in cols:
            extras[f"{name}_missing_{c}"] = F.count_if(on & is_missing(rows, c))
    found = ecdf.profile(rows, numeric, extras, rows_per_bucket)
    values = durable(ecdf.value_counts(rows, numeric, found.splits, _both_sides())) if numeric else None
    return Pair(rows, numeric, categorical, values, found.extras)


def _side_counts(rows: DataFrame, cols: Sequence[str], side: str) -> dict[str, Column]:
    return {f"{side}_rows": F.count(F.lit(1))} | {f"{side}_missing_{c}": F.count_if(is_missing(rows, c)) for c in cols}


def _cells(rows: DataFrame, categorical: Sequence[str]) -> DataFrame:
    lines = [F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in categorical]
    return rows.select(F.inline(F.array(*lines))).groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Reference:
    """A reference table reduced to what drift needs: per column its value or category counts, edges, and row counts.

    Fitted once and saved; a batch that is compared with it reads no reference row again.
    """

    numeric: list[str]
    categorical: list[str]
    splits: dict[str, list[float]]
    edges: dict[str, list[float]]
    counts: dict[str, int]
    values: DataFrame | None  # (column, [bucket,] value, n_ref)
    categories: DataFrame | None  # (column, category, n)

    def save(self, path: str) -> None:
        """Write the tables and, as one row of JSON, the rest."""
        facts = json.dumps({k: getattr(self, k) for k in ("numeric", "categorical", "splits", "edges", "counts")})
        spark = (self.values if self.values is not None else self.categories).sparkSession
        spark.createDataFrame([(facts,)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")
        for name in ("values", "categories"):
            if getattr(self, name) is not None:
                getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load_reference(spark: SparkSession, path: str) -> Reference:
    facts = json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])
    values = spark.read.parquet(f"{path}/values") if facts["numeric"] else None
    return Reference(**facts, values=values, categories=spark.read.parquet(f"{path}/categories") if facts["categorical"] else None)


def fit_reference(
    reference: DataFrame,
    features: Sequence[str] | None = None,
    limits: DriftLimits = LIMITS,
    rows_per_bucket: int = ecdf.ROWS_PER_BUCKET,
) -> Reference:
    """Reduce a reference table: one pass for split points and row counts, one for the value counts."""
    cols = common_columns(reference, reference, features)
    numeric = [c for c in cols if isinstance(reference.schema[c].dataType, NUMERIC)]
    categorical = [c for c in cols if c not in numeric]
    rows = reference.select(*[F.col(c).cast("double" if c in numeric else "string").alias(c) for c in cols])
    found = ecdf.profile(rows, numeric, _side_counts(rows, cols, "ref"), rows_per_bucket)
    values = durable(ecdf.value_counts(rows, numeric, found.splits, {"n_ref": F.lit(1)})) if numeric else None
    categories = durable(_cells(rows, categorical)) if categorical else None
    fitted = Reference(numeric, categorical, found.splits, {}, found.extras, values, categories)
    edges = psi_edges(Pair(rows, numeric, categorical, values, found.extras), limits) if numeric else {}
    return replace(fitted, edges=edges)


def pair_with(reference: Reference, current: DataFrame) -> Pair:
    """Pair a fitted reference with a current table: only the current rows are read and counted."""
    numeric = [c for c in reference.numeric if c in current.columns]
    categorical = [c for c in reference.categorical if c in current.columns]
    cols = [*numeric, *categorical]
    rows = current.select(*[F.col(c).cast("double" if c in numeric else "string").alias(c) for c in cols])
    sides = _side_counts(rows, cols, "cur")
    got = rows.agg(*[v.alias(k) for k, v in sides.items()]).first().asDict()
    values = categories = None
    if numeric:
        new = ecdf.value_counts(rows, numeric, reference.splits, {"n_cur": F.lit(1)})
        old = reference.values.where(F.col("column").isin(numeric))
        if "bucket" in old.columns and "bucket" not in new.columns:
            new = new.withColumn("bucket", F.lit(0))
        both = old.withColumn("n_cur", F.lit(0).cast("long")).unionByName(new.withColumn("n_ref", F.lit(0).cast("long")))
        keys = [c for c in ("column", "bucket", "value") if c in both.columns]
        values = durable(both.groupBy(*keys).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")))
    if categorical:
        old = reference.categories.where(F.col("column").isin(categorical))
        both = old.select("column", "category", F.col("n").alias("c_ref"), F.lit(0).cast("long").alias("c_cur")).unionByName(
            _cells(rows, categorical).select("column", "category", F.lit(0).cast("long").alias("c_ref"), F.col("n").alias("c_cur"))
        )
        categories = both.groupBy("column", "category").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    return Pair(rows, numeric, categorical, values, reference.counts | got, categories, reference.edges)


def _paired(
    reference: DataFrame | Reference,
    current: DataFrame,
    features: Sequence[str] | None = None,
    rows_per_bucket: int = ecdf.ROWS_PER_BUCKET,
) -> Pair:
    if isinstance(reference, Reference):
        return pair_with(reference, current)
    return pair_up(reference, current, features, rows_per_bucket)


def _both_sides() -> dict[str, Column]:
    return {"n_ref": F.col(SIDE).cast("int"), "n_cur": (~F.col(SIDE)).cast("int")}


def psi_edges(pair: Pair, limits: DriftLimits = LIMITS) -> dict[str, list[float]]:
    """Distinct percentiles of the reference per column, with fewer bins for a small reference.

    At most eleven numbers per column come to the driver.
    """
    if pair.edges is not None:
        return pair.edges
    probs = {}
    for c in pair.numeric:
        bins = min(limits.psi_bins, max(limits.psi_min_bins, pair.present("ref", c) // limits.psi_rows_per_bin))
        probs[c] = F.array(*[F.lit(i * (100.0 / bins) / 100.0) for i in range(bins + 1)])
    reference = pair.values.where(F.col("n_ref") > 0)
    by_column = F.element_at(F.create_map(*[x for c, a in probs.items() for x in (F.lit(c), a)]), F.col("column"))
    found = ecdf.percentiles_of_counts(reference, ["column"], by_column, "n_ref").collect()
    return {r["column"]: sorted(set(r["quantiles"])) for r in found}


def psi_of(cells: Column, bins: Column, n_ref: Column, n_cur: Column, limits: DriftLimits = LIMITS) -> Column:
    """PSI from an array of (c_ref, c_cur) structs. Bins that are empty on both sides may be absent.

    Shares get epsilon added and are scaled back to one; with all bins counted their sum is
    1 + bins * epsilon. A bin empty on both sides adds exactly nothing.
    """
    eps = F.lit(limits.psi_epsilon)
    scale = F.lit(1.0) + bins * eps

    def term(x: Column) -> Column:
        r = (x["c_ref"] / n_ref + eps) / scale
        c = (x["c_cur"] / n_cur + eps) / scale
        return (c - r) * F.log(c / r)

    total = F.aggregate(F.transform(cells, term), F.lit(0.0), lambda a, b: a + b)
    enough = (n_ref >= limits.psi_min_rows) & (n_cur >= limits.psi_min_rows) & (bins >= 1)
    return F.when(enough, F.least(F.greatest(total, F.lit(0.0)), F.lit(limits.psi_cap))).otherwise(0.0)


def numeric_statistics(pair: Pair, limits: DriftLimits = LIMITS) -> DataFrame:
    """(column, n_ref, n_cur, ks_statistic, wasserstein_distance, psi) of all numeric columns in one pass."""
    edges = psi_edges(pair, limits)
    # one row per column: its inner edges side by side, and how many bins they make
    width = limits.psi_bins - 1
    names = [f"__e{i}" for i in range(width)]
    lines = []
    for c in pair.numeric:
        points = edges.get(c, [])
        inner = points[1:-1]
        lines.append((c, max(len(points) - 1, 0), *inner, *[None] * (width - len(inner))))
    schema = "column string, __bins int" + "".join(f", {e} double" for e in names)
    table = pair.rows.sparkSession.createDataFrame(lines, schema)
    prefix = ecdf.prefix_sums(pair.values, ["column"], ["n_ref", "n_cur"]).join(F.broadcast(table), "column")
    reached = [F.coalesce((F.col("value") >= F.col(e)).cast("int"), F.lit(0)) for e in names]
    f = (F.col("below_n_ref") + F.col("n_ref")) / F.nullif(F.col("total_n_ref"), F.lit(0))
    g = (F.col("below_n_cur") + F.col("n_cur")) / F.nullif(F.col("total_n_cur"), F.lit(0))
    per_bin = (
        prefix.withColumns({"__gap": F.abs(f - g), "bin": sum(reached, F.lit(0))})
        .groupBy("column", "bin")
        .agg(
            F.max("__bins").alias("__bins"),
            F.max("__gap").alias("__ks"),
            F.sum(F.col("__gap") * (F.col("next_value") - F.col("value"))).alias("__w"),
            F.sum("n_ref").alias("c_ref"),
            F.sum("n_cur").alias("c_cur"),
        )
    )
    # at most ten rows per column are left
    return (
        per_bin.groupBy("column")
        .agg(
            F.max("__bins").alias("__bins"),
            F.sum("c_ref").alias("n_ref"),
            F.sum("c_cur").alias("n_cur"),
            F.max("__ks").alias("ks_statistic"),
            F.coalesce(F.sum("__w"), F.lit(0.0)).alias("wasserstein_distance"),
            F.collect_list(F.struct("c_ref", "c_cur")).alias("__cells"),
        )
        .withColumn("psi", psi_of(F.col("__cells"), F.col("__bins"), F.col("n_ref"), F.col("n_cur"), limits))
        .drop("__cells", "__bins")
    )


def _missing_columns(pair: Pair, cols: Sequence[str]) -> dict[str, Column]:
    def pct(side: str) -> Column:
        rows = pair.counts[f"{side}_rows"]
        share = {c: round(100.0 * pair.counts[f"{side}_missing_{c}"] / rows, 2) if rows else 0.0 for c in cols}
        return lookup("column", share, 0.0)

    return {"reference_missing_pct": pct("ref"), "current_missing_pct": pct("cur")}


def numeric_report(pair: Pair, limits: DriftLimits = LIMITS) -> DataFrame:
    """One verdict row per numeric column."""
    names = pair.rows.sparkSession.createDataFrame([(c,) for c in pair.numeric], "column string")
    # one row per column on either side of this join
    found = names.join(F.broadcast(numeric_statistics(pair, limits)), "column", "left")
    least = F.least(F.coalesce("n_ref", F.lit(0)), F.coalesce("n_cur", F.lit(0)))
    enough = least >= limits.min_rows
    p = F.when(enough, ks_p("n_ref", "n_cur", "ks_statistic")).otherwise(1.0)
    scored = found.select(
        "column",
        F.when(enough, "Kolmogorov-Smirnov & PSI").otherwise("KS-Test & PSI").alias("test_name"),
        F.when(enough, F.col("ks_statistic")).otherwise(0.0).alias("ks_statistic"),
        p.alias("p_value"),
        F.when(enough, F.col("wasserstein_distance")).otherwise(0.0).alias("wasserstein_distance"),
        F.when(enough, F.coalesce("psi", F.lit(0.0))).otherwise(0.0).alias("psi"),
        F.when(enough, F.lit(limits.alpha)).alias("threshold"),
    )
    drift = ((F.col("p_value") < limits.alpha) & (F.col("psi") >= limits.psi_visible)) | (
        (F.col("p_value") < limits.p_marginal) & (F.col("psi") >= limits.psi_high)
    )
    return scored.withColumn("is_drift", drift).select(
        "column",
        "test_name",
        F.round("ks_statistic", 4).alias("ks_statistic"),
        F.round("p_value", 6).alias("p_value"),
        F.round("wasserstein_distance", 4).alias("wasserstein_distance"),
        F.round("psi", 4).alias("psi"),
        "threshold",
        "is_drift",
        F.round("psi", 4).alias("drift_score"),
        F.lit("numerical").alias("column_type"),
        *[c.alias(k) for k, c in _missing_columns(pair, pair.numeric).items()],
    )


def category_counts(pair: Pair) -> DataFrame:
    """(column, category, c_ref, c_cur); a missing value is a category (NULL) of its own."""
    if pair.categories is not None:
        return pair.categories
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("category")) for c in pair.categorical]
    sides = _both_sides()
    return (
        pair.rows.select(*[w.alias(k) for k, w in sides.items()], F.inline(F.array(*cells)))
        .groupBy("column", "category")
        .agg(F.sum("n_ref").alias("c_ref"), F.sum("n_cur").alias("c_cur"))
    )


def category_distances(counts: DataFrame, pair: Pair, limits: DriftLimits = LIMITS) -> DataFrame:
    """(column, n_ref, n_cur, tvd, statistic, dof, unseen_share).

    An empty side counts as uniform over the categories. Categories that the reference does not
    have take no part in the statistic; their share of the current rows is told apart.
    """
    n_ref, n_cur = pair.counts["ref_rows"], pair.counts["cur_rows"]
    # distinct counts stay small enough to send: one number per column
    k = counts.groupBy("column").agg(F.count(F.lit(1)).alias("__k"))
    shares = counts.join(F.broadcast(k), "column")
    p = F.col("c_ref") / F.lit(float(n_ref)) if n_ref else 1.0 / F.col("__k")
    q = F.col("c_cur") / F.lit(float(n_cur)) if n_cur else 1.0 / F.col("__k")
    expected = p * F.lit(float(n_cur))
    known = expected > 0
    summed = shares.groupBy("column").agg(
        (F.sum(F.abs(q - p)) * 0.5).alias("tvd"),
        F.sum(F.when(known, (F.col("c_cur") - expected) ** 2 / expected)).alias("__chi2"),
        F.count_if(known).alias("__valid"),
        F.sum(F.when(~known, F.col("c_cur")).otherwise(0)).alias("__unseen"),
    )
    tested = (F.col("__valid") > 1) & F.lit(n_cur >= limits.chi2_min_rows)
    return summed.select(
        "column",
        F.lit(n_ref).cast("long").alias("n_ref"),
        F.lit(n_cur).cast("long").alias("n_cur"),
        "tvd",
        F.when(tested, F.col("__chi2")).otherwise(0.0).alias("statistic"),
        F.when(tested, F.col("__valid") - 1).otherwise(0).cast("long").alias("dof"),
        (F.col("__unseen") / F.lit(float(max(n_cur, 1)))).alias("unseen_share"),
    )


def categorical_report(pair: Pair, limits: DriftLimits = LIMITS) -> DataFrame:
    """One verdict row per categorical column."""
    found = category_distances(category_counts(pair), pair, limits)
    p = F.when(F.col("dof") > 0, chi2_p("statistic", F.col("dof").cast("double"))).otherwise(1.0)
    tvd = F.col("tvd")
    scored = found.withColumn("p_value", p).withColumn(
        "is_drift",
        ((F.col("p_value") < limits.alpha) & (tvd >= limits.tvd_visible)) | (tvd >= limits.tvd_high),
    )
    return scored.select(
        "column",
        F.lit("Chi-Square & TVD").alias("test_name"),
        F.round("statistic", 4).alias("statistic"),
        F.round("tvd", 4).alias("tvd"),
        F.round("p_value", 6).alias("p_value"),
        F.lit(limits.alpha).alias("threshold"),
        "is_drift",
        F.round("tvd", 4).alias("drift_score"),
        F.lit("categorical").alias("column_type"),
        F.round("unseen_share", 6).alias("unseen_share"),
        *[c.alias(k) for k, c in _missing_columns(pair, pair.categorical).items()],
    )


def drift_report(
    reference: DataFrame | Reference,
    current: DataFrame,
    features: Sequence[str] | None = None,
    limits: DriftLimits = LIMITS,
    rows_per_bucket: int = ecdf.ROWS_PER_BUCKET,
    pair: Pair | None = None,
) -> DataFrame:
    """One row per shared column, numeric and categorical. A fitted reference has its columns chosen already."""
    pair = pair or _paired(reference, current, features, rows_per_bucket)
    parts = []
    if pair.numeric:
        parts.append(numeric_report(pair, limits))
    if pair.categorical:
        parts.append(categorical_report(pair, limits))
    if not parts:
        raise ValueError("the two sides share no column")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def drift_summary(report: DataFrame, pair: Pair, limits: DriftLimits = LIMITS) -> DataFrame:
    """One row: share of drifting columns and the data-set flag."""
    share = F.when(F.col("__n") > 0, F.col("__d") / F.col("__n")).otherwise(0.0)
    return report.agg(F.count(F.lit(1)).alias("__n"), F.count_if("is_drift").alias("__d")).select(
        (share >= limits.share).alias("dataset_drift"),
        F.round(share, 4).alias("drift_share"),
        F.lit(limits.share).alias("drift_share_threshold"),
        F.col("__n").alias("number_of_features"),
        F.col("__d").alias("number_of_drifted_features"),
        F.lit(pair.counts["ref_rows"]).cast("long").alias("reference_rows"),
        F.lit(pair.counts["cur_rows"]).cast("long").alias("current_rows"),
        F.lit(limits.alpha).alias("alpha"),
    )


def display_table(report: DataFrame) -> DataFrame:
    """The report as shown to a reader: status, the leading metric and the p-value as text."""
    cols = report.columns
    psi_col = F.col("psi") if "psi" in cols else F.lit(None).cast("double")
    tvd_col = F.col("tvd") if "tvd" in cols else F.lit(None).cast("double")
    numeric = F.col("column_type") == "numerical"
    return report.select(
        "column",
        "column_type",
        "test_name",
        F.when(numeric, "PSI").otherwise("TVD").alias("metric_name"),
        F.when(numeric, psi_col).otherwise(tvd_col).alias("metric_value"),
        p_value_text("p_value").alias("p_value_text"),
        F.when(F.col("is_drift"), "DRIFT").otherwise("OK").alias("status"),
    ).orderBy("column")


def prediction_rows(df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
    """The columns that prediction drift looks at. Fit a baseline on these."""
    return df.select(
        F.col(probability).cast("double").alias("probability"), F.col(prediction).cast("string").alias("decision")
    )


def prediction_drift(
    baseline: DataFrame | Reference,
    current: DataFrame,
    probability: str = "probability",
    prediction: str = "prediction",
    limits: DriftLimits = LIMITS,
) -> DataFrame:
    """One row: drift of the scores and of the decided class, with a severity.

    Both inputs hold a probability and a 0/1 prediction column; the baseline may be fitted on `prediction_rows`.
    """
    spark = current.sparkSession
    if not isinstance(baseline, Reference):
        baseline = prediction_rows(baseline, probability, prediction)
    pair = _paired(baseline, prediction_rows(current, probability, prediction))
    n_ref, n_cur = pair.counts["ref_rows"], pair.counts["cur_rows"]
    schema = (
        "sample_size long, baseline_samples long, psi double, ks_statistic double, p_value double, "
        "wasserstein_distance double, probability_drift boolean, tvd double, decision_drift boolean, "
        "overall_status string, is_drift_detected boolean"
    )
    if n_ref < limits.prediction_min_baseline or n_cur < limits.prediction_min_current:
        status = "NO_BASELINE" if n_ref < limits.prediction_min_baseline else "COLLECTING_DATA"
        line = (n_cur, n_ref, 0.0, 0.0, 1.0, 0.0, False, 0.0, False, status, False)
        return spark.createDataFrame([line], schema)
    scores = numeric_report(pair, limits).select(
        "psi", "ks_statistic", "p_value", "wasserstein_distance", F.col("is_drift").alias("probability_drift")
    )
    classes = categorical_report(pair, limits).select(F.struct("tvd", "is_drift")).scalar()
    both = scores.select("*", classes["tvd"].alias("tvd"), classes["is_drift"].alias("decision_drift"))
    p_drift, d_drift = F.col("probability_drift"), F.col("decision_drift")
    status = (
        F.when((F.col("psi") >= limits.prediction_psi_critical) | (p_drift & d_drift), "CRITICAL_DRIFT")
        .when((F.col("psi") >= limits.prediction_psi_moderate) | p_drift | d_drift, "MODERATE_DRIFT")
        .otherwise("STABLE")
    )
    return both.select(
        F.lit(n_cur).cast("long").alias("sample_size"),
        F.lit(n_ref).cast("long").alias("baseline_samples"),
        "psi",
        "ks_statistic",
        "p_value",
        "wasserstein_distance",
        "probability_drift",
        "tvd",
        "decision_drift",
        status.alias("overall_status"),
        (status != "STABLE").alias("is_drift_detected"),
    )


def class_shift(
    reference: DataFrame,
    current: DataFrame,
    prediction: str = "prediction",
    probability: str | None = None,
    limits: DriftLimits = LIMITS,
) -> DataFrame:
    """One row: drift of the class (and of the probability, if given) with the positive rates of both sides."""

    def shaped(df: DataFrame) -> DataFrame:
        cells = [F.col(prediction).cast("string").alias("decision")]
        if probability:
            cells.append(F.col(probability).cast("double").alias("probability"))
        return df.select(*cells)

    pair = pair_up(shaped(reference), shaped(current))
    classes = categorical_report(pair, limits).select("tvd", "statistic", "p_value", F.col("is_drift").alias("class_drift"))

    def rate(df: DataFrame) -> Column:
        return df.agg(F.round(F.avg(F.col(prediction).cast("double")), 4)).scalar()

    score_drift = numeric_report(pair, limits).select("is_drift").scalar() if probability else F.lit(False)
    return classes.select(
        (F.col("class_drift") | score_drift).alias("prediction_drift"),
        "class_drift",
        score_drift.alias("probability_drift"),
        "tvd",
        "statistic",
        rate(reference).alias("reference_positive_rate"),
        rate(current).alias("current_positive_rate"),
    )


def unseen_categories(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, category, n): current categories that the reference does not have."""

    def cells(df: DataFrame) -> DataFrame:
        lines = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols]
        return df.select(F.inline(F.array(*lines))).groupBy("column", "category").agg(F.count(F.lit(1)).alias("n"))

    new, old = cells(current).alias("new"), cells(reference).alias("old")
    same = (F.col("new.column") == F.col("old.column")) & F.col("new.category").eqNullSafe(F.col("old.category"))
    return new.join(old, same, "left_anti")


@dataclass(frozen=True)
class Baseline:
    """PSI edges and reference counts per bin of one score, small enough to be literals in a stream."""

    edges: tuple[float, ...]
    counts: tuple[int, ...]

    @property
    def bins(self) -> int:
        return len(self.counts)


def psi_baseline(reference: DataFrame, c: str, limits: DriftLimits = LIMITS) -> Baseline:
    """Fit the edges and bin counts of one column once; eleven numbers come to the driver."""
    n = reference.where(~is_missing(reference, c)).count()
    bins = min(limits.psi_bins, max(limits.psi_min_bins, n // limits.psi_rows_per_bin))
    found = ecdf.percentiles(reference, [c], [(i * (100.0 / bins)) / 100.0 for i in range(bins + 1)]).first()
    edges = sorted(set(found["quantiles"])) if found else []
    inner = edges[1:-1]
    per_bin = reference.select(bucket_index(nan_to_null(c), inner).alias("b")).where("b is not null").groupBy("b").count()
    counts = {r["b"]: r["count"] for r in per_bin.collect()}
    return Baseline(tuple(inner), tuple(counts.get(i, 0) for i in range(max(len(edges) - 1, 0))))


def psi_from_counts(baseline: Baseline, counts: Sequence[Column], limits: DriftLimits = LIMITS) -> Column:
    """PSI of one row that holds the current count of each bin, against literal reference counts."""
    n_cur = sum((col(c) for c in counts[1:]), col(counts[0]))
    cells = F.array(
        *[F.struct(F.lit(float(r)).alias("c_ref"), col(c).cast("double").alias("c_cur")) for r, c in zip(baseline.counts, counts)]
    )
    return psi_of(cells, F.lit(baseline.bins), F.lit(float(sum(baseline.counts))), n_cur.cast("double"), limits)
