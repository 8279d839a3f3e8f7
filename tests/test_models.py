import numpy as np
import pandas as pd
import pytest
from driftloom.operators import attribution, metrics
from driftloom.operators.folds import stratified_folds
from driftloom.operators.scoring import decide, inference_metrics, positive_probability
from driftloom.plans import benchmark, calibration, features, learners, oof, search, selection, stacking, training
from driftloom.plans.learners import Learner
from driftloom.specs import LABELLED_SCHEMA, SEARCH_SPACES
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

LOGISTIC = Learner("lr", "logistic", {"regParam": 0.01})
FOREST = Learner("rf", "forest", {"numTrees": 5, "maxDepth": 3})
COLS = ["a", "b", "noise"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 400
    x = rng.normal(0, 1, (n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.5, n) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "noise": x[:, 2], "label": y}))
    df = VectorAssembler(inputCols=COLS, outputCol="features").transform(df)
    return stratified_folds(df, "label", "id", 3).cache()


def auc(df, p="p"):
    return metrics.ranking_metrics(df, "label", p).first()["auc"]


def test_every_row_is_scored_once_by_a_model_that_has_not_seen_it(rows):
    scores = oof.out_of_fold(rows, lambda: LOGISTIC.estimator(), "fold", 3, ["id", "label"])
    assert scores.count() == 400 and scores.select("id").distinct().count() == 400
    assert auc(scores) > 0.85
    models = oof.fold_models(rows, lambda: LOGISTIC.estimator(), "fold", 3)
    assert oof.mean_of_folds(rows, models, ["id"]).where("p between 0 and 1").count() == 400


def test_exact_area_agrees_with_the_binned_evaluator(rows):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    scored = LOGISTIC.estimator().fit(rows).transform(rows)
    ours = auc(scored.withColumn("p", positive_probability()))
    assert ours == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(scored), abs=1e-9)


def test_stacking_voting_and_their_artefacts(rows, tmp_path):
    model = stacking.StackingEstimator([LOGISTIC, FOREST], "id", folds=2).fit(rows.drop("fold"))
    weights = {r["model"]: r["weight"] for r in model.weights(rows.sparkSession).collect()}
    assert set(weights) == {"lr", "rf", "intercept"} and weights["lr"] > 0
    vote = stacking.VotingEstimator([LOGISTIC, FOREST], [3.0, 1.0]).fit(rows)
    for i, m in enumerate((model, vote)):
        out = m.transform(rows).withColumn("p", positive_probability())
        assert auc(out) > 0.85
        m.write().save(str(tmp_path / str(i)))
        again = type(m).load(str(tmp_path / str(i))).transform(rows).withColumn("p", positive_probability())
        assert again.join(out, "id").where(F.abs(again["p"] - out["p"]) > 1e-12).count() == 0
    p1 = LOGISTIC.estimator().fit(rows).transform(rows).select("id", positive_probability().alias("x"))
    p2 = FOREST.estimator().fit(rows).transform(rows).select("id", positive_probability().alias("z"))
    both = vote.transform(rows).select("id", positive_probability().alias("v")).join(p1, "id").join(p2, "id")
    assert both.where(F.abs(F.col("v") - (F.col("x") * 3 + F.col("z")) / 4) > 1e-12).count() == 0


def test_shallow_meta_learner(rows):
    meta = Learner("meta", "gbt", {"maxIter": 2, "maxDepth": 2})
    model = stacking.StackingEstimator([LOGISTIC, FOREST], "id", folds=2, meta=meta, exact_folds=False).fit(rows.drop("fold"))
    assert {r["model"] for r in model.weights(rows.sparkSession).collect()} == {"lr", "rf"}


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration_improves_a_distorted_score(rows, method, tmp_path):
    model = calibration.CalibratedEstimator(lambda: FOREST.estimator(), "id", method=method, folds=3).fit(rows.drop("fold"))
    out = model.transform(rows).withColumn("p", positive_probability())
    plain = FOREST.estimator().fit(rows).transform(rows).withColumn("p", positive_probability() * 0.3)
    assert metrics.brier(out, "label", "p").first()[0] < metrics.brier(plain, "label", "p").first()[0]
    model.write().save(str(tmp_path / "c"))
    again = calibration.CalibratedModel.load(str(tmp_path / "c")).transform(rows).withColumn("p", positive_probability())
    assert auc(again) == pytest.approx(auc(out), abs=1e-12)


def test_isotonic_map_equals_pooling_of_adjacent_violators(spark):
    rng = np.random.default_rng(0)
    s = np.round(rng.random(300), 2)
    y = (rng.random(300) < s).astype(int)
    fitted = calibration.fit_map(spark.createDataFrame(pd.DataFrame({"s": s, "y": y})), "y", "s", "isotonic")
    blocks = []
    for v in np.unique(s):
        blocks.append([y[s == v].mean(), float((s == v).sum()), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, k = blocks.pop()
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + m * w) / (blocks[-1][1] + w), blocks[-1][1] + w, blocks[-1][2] + k]
    truth = np.concatenate([[m] * k for m, _, k in blocks])
    points = spark.createDataFrame([(float(v),) for v in np.unique(s)], "__score double")
    got = [r["__calibrated"] for r in fitted.transform(points).orderBy("__score").collect()]
    assert np.allclose(got, truth)


def test_elimination_drops_the_noise_first(rows):
    found = selection.select_features(rows.drop("features"), COLS, LOGISTIC, "label", "fold", 3)
    assert found.ranking[found.features[0]] == 1 and "a" in found.features
    assert [r["n_features"] for r in found.sizes.orderBy("n_features").collect()] == [1, 2, 3]
    if len(found.features) < 3:
        assert max(found.ranking, key=found.ranking.get) == "noise"


def test_search_draws_stay_in_their_spaces_and_repeat():
    trials = search.draw_trials(200, seed=3)
    assert trials == search.draw_trials(200, seed=3) != search.draw_trials(200, seed=4)
    assert {t["family"] for t in trials} == set(SEARCH_SPACES)
    for t in trials:
        for s in SEARCH_SPACES[t["family"]]:
            v = t["params"][s.name]
            assert v in s.choices if s.choices else s.low <= v <= s.high
            assert not s.step or (v - s.low) % s.step == 0
        assert learners.from_search(t["family"], t["params"]).estimator() is not None


def test_search_and_benchmark_tables(rows):
    trials = [{"trial": i, "family": "lr", "params": {"c": c}} for i, c in enumerate((0.001, 100.0))]
    to_learner = lambda family, p: Learner(family, "logistic", {"regParam": p["c"]})
    found = search.random_search(rows, "label", "fold", 3, trials, to_learner)
    assert found.count() == 2 and search.best_trial(found)["hyperparameters"]["c"] in (0.001, 100.0)
    table = benchmark.run_benchmark(rows, {"lr": lambda: LOGISTIC.estimator(), "rf": lambda: FOREST.estimator()}, "id", "label", "fold", 3)
    assert table.columns == ["algorithm", "cv_accuracy", "cv_f1_macro", "cv_roc_auc", "train_accuracy", "train_roc_auc"]
    assert benchmark.winner(table) in ("lr", "rf") and table.count() == 2


def test_attributions_rank_the_signal_first(rows):
    model = LOGISTIC.estimator().fit(rows)
    plain = rows.drop("features")
    exact = attribution.linear_attribution(plain, dict(zip(COLS, model.coefficients.toArray())))
    sampled = attribution.shapley_sampled(plain, model, COLS, "id", plain.where("id % 10 = 0"), 2)
    lost = attribution.permutation_importance(plain, model, COLS, "label", "id")
    for table, value in ((exact, "mean_abs_contribution"), (sampled, "mean_abs_contribution"), (lost, "auc_drop")):
        order = [r["feature"] for r in table.orderBy(F.desc(value)).collect()]
        assert order[0] == "a" and len(order) == 3


def test_sampled_contributions_add_up(rows):
    """For a linear score on the probability scale a path's jumps sum to the change from background to row."""
    model = LOGISTIC.estimator().fit(rows)
    one = rows.drop("features").where("id = 7")
    got = attribution.shapley_sampled(one, model, COLS, "id", one, 3)
    assert all(abs(r["mean_abs_contribution"]) < 1e-12 for r in got.collect())


def people(spark, n=120):
    rng = np.random.default_rng(11)
    titles = ["Mr", "Mrs", "Miss", "Master", "Dr", "Mlle", "Col"]
    data = []
    for i in range(1, n + 1):
        female = bool(rng.random() < 0.4)
        title = "Mrs" if female else titles[int(rng.integers(0, 7))]
        data.append(
            (
                i, int(rng.random() < (0.8 if female else 0.2)), int(rng.integers(1, 4)), f"Fam{i}, {title}. X", "female" if female else "male",
                None if i % 6 == 0 else float(rng.integers(1, 80)), int(rng.integers(0, 3)), int(rng.integers(0, 2)),
                f"PC {i % 20}" if i % 2 else str(1000 + i % 30), None if i % 50 == 0 else float(np.round(rng.exponential(30), 2)),
                f"C{i}" if i % 4 == 0 else None, None if i == 5 else "SCQ"[int(rng.integers(0, 3))],
            )
        )
    return spark.createDataFrame(data, LABELLED_SCHEMA)


@pytest.fixture(scope="module")
def built(spark):
    df = people(spark).cache()
    return df, *features.FeatureBuilder().fit_transform(df)


def test_features_have_one_schema_and_no_gaps(spark, built):
    df, model, train = built
    new = df.drop("Survived").where("PassengerId <= 3").withColumn("Embarked", F.lit(None).cast("string"))
    out = model.transform(new)
    assert out.columns == ["PassengerId", *model.columns] and train.columns == ["PassengerId", "Survived", *model.columns]
    for frame in (train, out):
        assert frame.where(" or ".join(f"`{c}` is null or isnan(`{c}`)" for c in model.columns)).count() == 0
    assert train.count() == 120 and "Age_is_na" in model.columns and "Sex_male" in model.columns and "Sex_female" not in model.columns


def test_training_rows_get_out_of_fold_encodings(built):
    df, model, train = built
    plain = model.transform(df)
    moved = train.join(plain, "PassengerId").where(F.abs(train["Title_TE"] - plain["Title_TE"]) > 1e-9).count()
    assert moved > 100
    leaky = features.FeatureBuilder().fit_transform(df, leaky=True)[1].select("PassengerId", F.col("Title_TE").alias("t"))
    assert leaky.join(plain, "PassengerId").where(F.abs(F.col("t") - F.col("Title_TE")) < 1e-12).count() == 120


def test_builder_artefact_and_default_prior(spark, built, tmp_path):
    df, model, _ = built
    model.write().save(str(tmp_path / "f"))
    again = features.FeatureBuilderModel.load(str(tmp_path / "f"))
    key = "PassengerId"
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(map(tuple, model.transform(df).collect()))
    blind = features.FeatureBuilder(label=None).fit(df.drop("Survived"))
    assert {r["Title_TE"] for r in blind.transform(df.drop("Survived")).select(key, "Title_TE").collect()} == {0.3838}


def test_twenty_thousand_categories(spark):
    from driftloom.operators import encode

    df = spark.range(20_500).select(F.col("id"), F.concat(F.lit("k"), F.col("id")).alias("c")).union(spark.createDataFrame([(-1, None)], "id long, c string"))
    index = encode.category_index(df, "c")
    encoder = encode.flag_encoder("c", 20_501)
    new = spark.createDataFrame([(0, "k0"), (1, "k1"), (2, "unseen"), (3, None)], "id long, c string")
    got = {r["id"]: r["c_flags"] for r in encode.sparse_flags(new, index, "c", encoder).collect()}
    order = sorted([f"k{i}" for i in range(20_500)] + ["nan"])
    for i, value in ((0, "k0"), (1, "k1"), (3, "nan")):
        place = order.index(value) - 1
        assert got[i].size == 20_500 and got[i].indices.tolist() == ([place] if place >= 0 else [])
    assert got[2].numNonzeros() == 0


def test_two_rows_are_enough(spark):
    df = people(spark, 2)
    model, train = features.FeatureBuilder().fit_transform(df)
    assert train.count() == 2 and model.transform(people(spark, 3).drop("Survived").where("PassengerId = 3")).columns[1:] == model.columns


@pytest.mark.parametrize("mode", ["stacking", "voting", "single"])
def test_training_job(spark, mode, tmp_path):
    df = people(spark)
    config = training.TrainConfig(
        mode, bases=[LOGISTIC, FOREST], folds=2, inner_folds=2, select=mode == "single", selector=LOGISTIC, select_step=15,
        calibrate={"stacking": None, "voting": "sigmoid", "single": "isotonic"}[mode], least_auc=0.5, inside=mode == "voting",
    )
    result = training.train(df, config)
    assert result.metrics["roc_auc"] > 0.5 and 0.1 <= result.threshold <= 0.9
    assert result.scores.count() == 120 and result.sweep.count() == 80
    registry = training.register(None, result, spark, least=0.5)
    row = registry.first()
    assert row["is_champion"] and row["version"] == 1
    raw = df.drop("Survived")
    loaded = training.score(training.load(row["artefact"]), raw, "PassengerId", result.threshold)
    direct = training.score(result.pipeline, raw, "PassengerId", result.threshold)
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, direct.collect())) and loaded.count() == 120
    assert result.metadata(spark).first()["features_count"] == len(result.features)
    if mode == "single":
        assert result.selection is not None and result.weights is None


def test_decisions_use_the_unrounded_probability(spark):
    df = spark.createDataFrame([(1, 0.69996), (2, 0.7), (3, 0.39999), (4, 0.4)], "id long, p double")
    got = {r["id"]: (r["prediction"], r["probability"], r["risk_level"]) for r in decide(df, "id", "p", 0.7).collect()}
    assert got[1] == (0, 0.7, "Moderate") and got[2] == (1, 0.7, "High") and got[3][2] == "Low" and got[4][2] == "Moderate"


def test_metrics_of_an_empty_buffer(spark):
    empty = spark.createDataFrame([], "id long, probability double, prediction int")
    row = inference_metrics(empty, ["id"], 0.39).first()
    assert row["buffer_status"] == "AWAITING_INFERENCES" and row["average_probability"] == 0.0 and row["total_inferences"] == 0


def test_rows_with_repeated_and_missing_ids_stay_as_they_are(spark):
    """The label stays on its row: as many training rows as records, each with its own label."""
    from driftloom.plans.features import FeatureBuilder

    kinds = "PassengerId int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int, Ticket string, Fare double, Cabin string, Embarked string, Survived int"
    rows = [
        (1 if i % 6 == 0 else None if i % 6 == 1 else i, i % 3 + 1, f"N{i}, Mr. X", "male" if i % 2 else "female", float(i % 60) if i % 7 else None,
         i % 3, i % 2, f"PC {i % 9}", float(i) if i % 10 else None, None, "SCQ"[i % 3], int(i % 4 == 0))
        for i in range(60)
    ]
    records = spark.createDataFrame(rows, kinds)
    for leaky in (False, True):
        _, out = FeatureBuilder(folds=3).fit_transform(records, leaky=leaky)
        got = out.select("PassengerId", "Survived").collect()
        key = lambda x: (str(x[0]), x[1])
        assert sorted(map(tuple, got), key=key) == sorted(((r[0], r[-1]) for r in rows), key=key)


def test_no_score_is_no_decision(spark):
    from driftloom.operators.scoring import decide

    df = spark.createDataFrame([(1, 0.9), (1, None), (2, float("nan")), (3, 0.1)], "id long, p double")
    got = sorted(map(tuple, decide(df, "id", "p", 0.5).collect()), key=str)
    assert got == sorted([(1, 1, 0.9, "Survived", "High"), (1, None, None, None, None), (2, None, None, None, None), (3, 0, 0.1, "Did Not Survive", "Low")], key=str)
