"""The whole training job: features, selection, out-of-fold scores, threshold, final fit, calibration, artefact."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.operators import encode, governance, metrics, scoring
from driftloom.operators.folds import stratified_folds
from driftloom.plans.calibration import CalibratedEstimator
from driftloom.plans.features import ColumnSelector, FeatureBuilder
from driftloom.plans.learners import META_C, SEED, STACK_BASES, TUNED_GBM, Learner, from_search
from driftloom.plans.oof import PARALLEL_FITS, fitted_fold_scores, fold_models, held_out_scores
from driftloom.plans.selection import Selection, select_features
from driftloom.plans.stacking import StackingEstimator, VotingEstimator
from driftloom.session import durable, durable_dir
from driftloom.specs import PROMOTION_AUC


@dataclass(frozen=True)
class TrainConfig:
    """mode: single, voting or stacking. inside: out-of-fold scores, and so the threshold and all metrics, come from features that
    were fitted without the held-out fold; columns are selected on the training features of all folds."""

    mode: str = "stacking"
    id_col: str = "PassengerId"
    label: str = "Survived"
    bases: Sequence[Learner] = STACK_BASES
    weights: Sequence[float] | None = None
    meta: Learner | None = None
    meta_c: float = META_C
    folds: int = 5
    inner_folds: int = 5
    select: bool = True
    selector: Learner = field(default_factory=lambda: Learner("select", "gbt", {"maxIter": 100}))
    select_step: int = 1
    calibrate: str | None = "isotonic"
    leaky: bool = False
    inside: bool = True
    least_auc: float = PROMOTION_AUC
    parallel: int = PARALLEL_FITS


@dataclass(frozen=True)
class TrainResult:
    pipeline: PipelineModel
    threshold: float
    metrics: dict[str, float]
    features: list[str]
    scores: DataFrame
    sweep: DataFrame
    weights: DataFrame | None
    selection: Selection | None

    def metadata(self, spark) -> DataFrame:
        """One row for a JSON sink."""
        row = (*(float(self.metrics[m]) for m in ("accuracy", "f1_macro", "roc_auc")), self.threshold, len(self.features), list(self.features))
        return spark.createDataFrame(
            [row],
            "cv_accuracy double, cv_f1_macro double, cv_roc_auc double, optimal_threshold double, "
            "features_count long, selected_features array<string>",
        )


def estimator(config: TrainConfig):
    if config.mode == "single":
        return config.bases[0].estimator("features", config.label)
    if config.mode == "voting":
        return VotingEstimator(config.bases, config.weights, config.label, parallel=config.parallel)
    if config.mode == "stacking":
        return StackingEstimator(
            config.bases, config.id_col, config.label, folds=config.inner_folds, meta=config.meta,
            meta_c=config.meta_c, parallel=config.parallel,
        )
    raise ValueError(f"unknown mode {config.mode}")


def learner_from_saved(saved: Mapping | None, fallback: Learner = TUNED_GBM) -> Learner:
    """The learner that a stored search result names, or the tuned default."""
    return from_search(saved["model_name"], saved["hyperparameters"]) if saved else fallback


def train(labelled: DataFrame, config: TrainConfig = TrainConfig()) -> TrainResult:
    """Run the job on labelled raw records."""
    id_col, label, k = config.id_col, config.label, config.folds
    builder = FeatureBuilder(id_col, label)
    feature_model, features = builder.fit_transform(labelled, leaky=config.leaky)
    features = durable(stratified_folds(features, label, id_col, k, SEED, "fold"))
    columns = list(feature_model.columns)
    selection = None
    if config.select:
        selection = select_features(
            features, columns, config.selector, label, "fold", k, config.select_step, parallel=config.parallel
        )
        columns = selection.features
    selector = ColumnSelector(columns, keep=[id_col, label, "fold"])
    rows = durable(selector.transform(features).select(id_col, label, "fold", "features"))
    if config.inside and not config.leaky:
        split = durable(stratified_folds(labelled, label, id_col, k, SEED, "fold"))
        _, inside = builder.fold_features(split, "fold", k)
        inside = encode.align(inside, columns, [id_col, label, "fold", "fit", "held"])
        inside = durable(ColumnSelector(columns, keep=[id_col, label, "fold", "fit", "held"]).transform(inside).drop(*columns))
        scores = durable(fitted_fold_scores(inside, lambda: estimator(config), k, [id_col, label, "fold"], parallel=config.parallel))
    else:
        models = fold_models(rows, lambda: estimator(config), "fold", k, config.parallel)
        scores = durable(held_out_scores(rows, models, "fold", [id_col, label]))
    sweep = durable(metrics.threshold_sweep(scores, label, "p", metrics.grid(*metrics.WIDE_GRID)))
    best = metrics.best_threshold(sweep).first()
    area = metrics.ranking_metrics(scores, label, "p").first()
    # the nested estimate: thresholds chosen per fold
    nested = metrics.cross_validated_threshold(scores, label, "p", "fold").first()
    found = {
        "accuracy": best["accuracy"],
        "f1_macro": best["f1_macro"],
        "roc_auc": area["auc"],
        "nested_threshold": nested["mean_optimal_threshold"],
        "nested_threshold_std": nested["std_threshold"],
        "mean_fold_auc": nested["mean_cv_auc"],
    }
    train_rows = rows.drop("fold")
    final = estimator(config).fit(train_rows)
    weights = final.weights(labelled.sparkSession) if config.mode == "stacking" else None
    if config.calibrate:
        final = CalibratedEstimator(
            lambda: estimator(config), id_col, label, config.calibrate, k, config.parallel
        ).fit(train_rows)
    pipeline = PipelineModel([feature_model, ColumnSelector(columns, keep=[id_col]), final])
    return TrainResult(pipeline, round(best["threshold"], 3), found, columns, scores, sweep, weights, selection)


def save(result: TrainResult, path: str) -> None:
    result.pipeline.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(pipeline: PipelineModel, records: DataFrame, id_col: str, threshold: float) -> DataFrame:
    """(id, prediction, probability, status, risk_level) for raw records."""
    scored = pipeline.transform(records).withColumn("__p", scoring.positive_probability())
    return scoring.decide(scored, id_col, "__p", threshold)


def register(registry: DataFrame | None, result: TrainResult, spark, least: float = PROMOTION_AUC) -> DataFrame:
    """The registry with the new version added, and what each version became."""
    entry = "version long, auc double, artefact string"
    latest = 0
    if registry is not None:
        registry = registry.select("version", "auc", "artefact")
        latest = registry.agg(F.max("version")).first()[0] or 0
    path = f"{durable_dir(spark)}/model-{uuid.uuid4().hex}"
    save(result, path)
    new = spark.createDataFrame([(latest + 1, float(result.metrics["roc_auc"]), path)], entry)
    full = new if registry is None else registry.unionByName(new)
    return governance.promotion_history(full, least=least)
