"""Statistics that leave a fold out, against a scan per fold."""

import numpy as np
import pandas as pd
import pytest
from driftloom.operators import encode, fold_fits, folds, knn
from driftloom.plans import features
from pyspark.sql import functions as F
from test_models import people

K = 4


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(2)
    n = 500
    frame = pd.DataFrame(
        {
            "id": np.arange(n), "fold": r.integers(0, K, n), "g": r.choice(["p", "q", "r"], n), "x": np.round(r.exponential(10, n), 1),
            "c": r.choice(["a", "b", "c", "d"], n), "label": r.integers(0, 2, n),
        }
    )
    frame.loc[frame.index % 9 == 0, "x"] = np.nan
    frame.loc[(frame.fold == 2) & (frame.index % 2 == 0), "c"] = "rare"
    frame.loc[frame.index % 50 == 7, "c"] = None
    return frame, spark.createDataFrame(frame).cache()


@pytest.mark.parametrize("rows_per_bucket", [200_000, 40])
def test_percentiles(rows, rows_per_bucket):
    frame, df = rows
    got = fold_fits.leave_out_percentiles(df, ["x"], [0.25, 0.5, 0.9], "fold", K, ["g"], rows_per_bucket).collect()
    assert len(got) == 3 * K
    for r in got:
        x = frame[(frame.fold != r["fit"]) & (frame.g == r["g"])].x.dropna()
        assert r["n"] == len(x) and np.allclose(r["quantiles"], np.quantile(x, [0.25, 0.5, 0.9]))


def test_modes_frequencies_categories(rows):
    frame, df = rows
    for r in fold_fits.leave_out_modes(df, ["c", "g"], "fold", K).collect():
        counts = frame[frame.fold != r["fit"]][r["column"]].value_counts()
        assert r["n"] == counts.max() and r["mode"] == min(counts[counts == counts.max()].index)
    freq = {(r["c"], r["fit"]): r["n"] for r in fold_fits.leave_out_frequencies(df, "c", "fold", K).collect()}
    want = {(c, f): n for f in range(K) for c, n in frame[frame.fold != f].c.value_counts().items()}
    assert freq == want and ("rare", 2) not in freq
    seen = {(r["category"], r["fit"]) for r in fold_fits.leave_out_categories(df, ["c"], "fold", K).collect()}
    assert seen == {*want, *[("nan", f) for f in range(K)]}


def test_nested_encodings_leave_out_both_folds(rows):
    frame, df = rows
    frame = frame.assign(c=frame.c.where(frame.c.notna(), "nan"))
    got = fold_fits.nested_encodings(df, ["c"], "label", "fold", None, K, 3.0).collect()
    assert len(got) == 6 * K * K
    for r in got:
        outside = frame[~frame.fold.isin([r["fit"], r["fold"]])]
        mine = outside[outside.c == r["category"]].label
        prior = outside.label.mean()
        assert r["n"] == len(mine) and r["encoding"] == pytest.approx((mine.sum() + 3 * prior) / (len(mine) + 3))


def test_one_fold_empty_tables_and_null_folds(spark, rows):
    _, df = rows
    one = df.withColumn("fold", F.lit(0))
    assert fold_fits.leave_out_percentiles(one, ["x"], [0.5], "fold", 1).count() == 0
    assert fold_fits.leave_out_modes(df.limit(0), ["c"], "fold", K).count() == 0
    assert fold_fits.nested_encodings(df.limit(0), ["c"], "label", "fold", None, K).count() == 0
    some = df.withColumn("fold", F.when(F.col("id") < 400, F.col("fold")))
    kept = fold_fits.leave_out_frequencies(some, "g", "fold", K).agg(F.sum("n")).first()[0]
    assert kept == 400 * (K - 1)


def test_neighbours_come_from_the_same_part_only(spark):
    r = np.random.default_rng(5)
    frame = pd.DataFrame({"id": np.arange(200), "fit": r.integers(0, 3, 200), "a": r.normal(0, 1, 200), "b": r.normal(0, 1, 200), "t": r.normal(0, 1, 200)})
    frame.loc[frame.index % 4 == 0, "t"] = np.nan
    df = spark.createDataFrame(frame)
    got = knn.knn_fill(df, df, ["a", "b", "t"], "id", 3, targets=["t"], donors_per_block=16, by="fit").select("id", "t").toPandas().set_index("id").t
    for f in range(3):
        part = spark.createDataFrame(frame[frame.fit == f])
        alone = knn.knn_fill(part, part, ["a", "b", "t"], "id", 3, targets=["t"]).select("id", "t").toPandas().set_index("id").t
        assert np.allclose(got.loc[alone.index], alone)


@pytest.fixture(scope="module")
def split(spark):
    return folds.stratified_folds(people(spark), "Survived", "PassengerId", 3).cache()


def test_held_out_features_are_those_of_a_model_that_never_saw_the_fold(split):
    """For the rows of each fold: the same features as fitting on the other folds alone and transforming them."""
    columns, rows = features.FeatureBuilder().fold_features(split, "fold", 3)
    assert rows.count() == 3 * 120 and rows.where("held").count() == 120
    for f in range(3):
        builder = features.FeatureBuilder().fit(split.where(F.col("fold") != f).drop("fold"))
        want = builder.transform(split.where(F.col("fold") == f).drop("Survived", "fold")).toPandas().set_index("PassengerId").sort_index()
        got = rows.where((F.col("fit") == f) & F.col("held")).toPandas().set_index("PassengerId").sort_index()
        # (flags: the builder leaves out the first category that it saw)
        both = [c for c in columns if c in want.columns]
        assert {"Age", "Fare", "Title_TE", "TicketFrequency", "FarePerPerson"} <= set(both)
        assert np.allclose(got[both].astype(float), want[both].astype(float), atol=1e-9)


def test_a_held_out_label_reaches_no_feature(split):
    turned = split.withColumn("Survived", F.when(F.col("fold") == 1, 1 - F.col("Survived")).otherwise(F.col("Survived")))
    read = lambda df: sorted(map(tuple, features.FeatureBuilder().fold_features(df, "fold", 3)[1].where("fit = 1").drop("Survived").collect()))
    assert read(split) == read(turned)


def test_target_tables_are_unchanged_by_the_further_key(rows):
    _, df = rows
    table = encode.fold_encoding(df, ["c"], "label", "fold")
    assert encode.apply_fold_encoding(df, table, ["c"], "fold").where("c_TE is null").count() == 0


@pytest.mark.parametrize("rare", [False, True])
def test_training_rows_of_two_folds_are_encoded_without_their_own_part(spark, rare):
    """Nothing is left outside a fit and the other fold, so that fold is cut into parts; with one row of a class, all of it counts."""
    df = people(spark).withColumn("fold", F.col("PassengerId") % 2)
    if rare:
        df = df.withColumn("Survived", F.col("PassengerId").isin(3, 4, 6).cast("int"))
    builder, seen = features.FeatureBuilder(), {}
    plain = builder.encoding_parts

    def spy(*given):
        seen["rows"], seen["part"], seen["parts"] = plain(*given)
        return seen["rows"], seen["part"], seen["parts"]

    builder.encoding_parts = spy
    got = builder.fold_features(df, "fold", 2)[1].toPandas()
    assert len(got) == 240 and got.held.sum() == 120 and not got.isna().any().any()
    assert seen["parts"] == 2 + (1 if rare else builder.folds)
    rows = seen["rows"].toPandas().merge(got[["PassengerId", "fit", "Title_TE"]], on=["PassengerId", "fit"])
    for r in rows.itertuples():
        others = rows[(rows.fit == r.fit) & (rows.fold != r.fit)]
        if not rare and r.fold != r.fit:
            others = others[others["__part"] != rows.loc[r.Index, "__part"]]
        prior, mine = others["__label"].mean(), others[others.Title == r.Title]["__label"]
        assert r.Title_TE == pytest.approx((mine.sum() + builder.m * prior) / (len(mine) + builder.m))
