import numpy as np
import pandas as pd
import pytest
from driftloom.operators import knn, mcar, mice, missing, patterns
from driftloom.plans.imputer import MissingImputer, MissingImputerModel, unfilled


def frame(spark, data):
    return spark.createDataFrame(pd.DataFrame(data))


def gappy(n=240, seed=7):
    """Three related columns with gaps that depend on nothing, some rows without two of them, some without any."""
    rng = np.random.default_rng(seed)
    z = rng.standard_normal((n, 3)) @ np.array([[2.0, 0.6, 0.0], [0.0, 1.0, -0.4], [0.0, 0.0, 0.5]]) + [3.0, -1.0, 20.0]
    z[rng.random((n, 3)) < [0.2, 0.12, 0.05]] = np.nan
    z[:3] = np.nan
    return {"u": z[:, 0], "v": z[:, 1], "w": z[:, 2]}


def fitted_moments(spark, data):
    return mcar.normal_moments(frame(spark, data), list(data), max_iter=400, tol=1e-9)


def log_likelihood(x, mu, sigma):
    """Of the observed cells of each row under a normal law."""
    total = 0.0
    for row in x:
        seen = ~np.isnan(row)
        if seen.any():
            s, r = sigma[np.ix_(seen, seen)], row[seen] - mu[seen]
            total -= 0.5 * (np.linalg.slogdet(2 * np.pi * s)[1] + r @ np.linalg.solve(s, r))
    return total


@pytest.mark.parametrize("on_driver", [True, False])
def test_fitted_moments_are_a_maximum_of_the_likelihood(spark, monkeypatch, on_driver):
    """By definition: no small step in any mean or covariance raises the likelihood of what was observed."""
    if not on_driver:
        monkeypatch.setattr(patterns, "DRIVER_NUMBERS", 1)
    data = gappy()
    x = np.column_stack(list(data.values()))
    mu, sigma = fitted_moments(spark, data)
    top = log_likelihood(x, mu, sigma)
    for i in range(3):
        for step in (-0.05, 0.05):
            moved = mu.copy()
            moved[i] += step * np.sqrt(sigma[i, i])
            assert log_likelihood(x, moved, sigma) < top
            for j in range(i + 1):
                other = sigma.copy()
                other[i, j] += step * np.sqrt(sigma[i, i] * sigma[j, j])
                other[j, i] = other[i, j]
                assert log_likelihood(x, mu, other) < top


@pytest.mark.parametrize("include_complete", [False, True])
@pytest.mark.parametrize("on_driver", [True, False])
def test_littles_statistic_from_the_fitted_moments(spark, monkeypatch, include_complete, on_driver):
    """Sum over patterns of n (mean - mu)' S^-1 (mean - mu); degrees: observed columns of the patterns less the columns."""
    if not on_driver:
        monkeypatch.setattr(patterns, "DRIVER_NUMBERS", 1)
    data = gappy()
    mu, sigma = fitted_moments(spark, data)
    table = pd.DataFrame(data)
    statistic, degrees = 0.0, -3
    for mask, rows in table.groupby([table[c].notna() for c in table], sort=False):
        seen = np.array(mask)
        degrees += seen.sum()
        if seen.any() and (include_complete or not seen.all()):
            away = rows.loc[:, seen].mean().to_numpy() - mu[seen]
            statistic += len(rows) * away @ np.linalg.solve(sigma[np.ix_(seen, seen)], away)
    got = mcar.littles_test(frame(spark, data), include_complete=include_complete)
    assert got.chi_square_stat == pytest.approx(statistic, abs=2e-3) and got.degrees_of_freedom == degrees
    assert got.total_records == 240


def test_complete_data_is_trivial(spark):
    got = mcar.littles_test(frame(spark, {"a": [1.0, 2.0, 3.0, 4.0, 5.0], "b": [2.0, 1.0, 4.0, 3.0, 5.0]}))
    assert got.is_mcar and got.p_value == 1.0 and got.recommended_strategy == "passthrough"
    nothing = mcar.littles_test(spark.createDataFrame([("a",)], "s string"))
    assert nothing.is_mcar and nothing.recommended_strategy == "mean"


def test_absence_that_depends_on_a_value_is_found(spark):
    random = frame(spark, gappy(seed=8))
    assert mcar.littles_test(random).p_value > 0.01
    assert mcar.patterns_of(random).count() >= 4
    even = np.arange(160.0)
    late = np.where(even > 120, np.nan, np.sin(even))
    got = mcar.littles_test(frame(spark, {"t": even, "s": late}))
    assert got.patterns_count == 2 and not got.is_mcar


def test_pattern_table(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (1.0, 1.0), (float("nan"), 2.0)], "a double, b double")
    rows = missing.missing_patterns(df, ["a", "b"]).orderBy("pattern_id").collect()
    assert [(r["pattern_id"], r["missing_columns"], r["count"]) for r in rows] == [(1, [], 1), (2, ["b"], 1), (3, ["a"], 2)]


def test_masks_of_many_columns(spark):
    names = [f"c{i:02d}" for i in range(70)]
    gone = [set(), {0}, {69}, {0, 69}, {33}, {0}]
    df = spark.createDataFrame([tuple(None if i in g else 1 for i in range(70)) for g in gone], ", ".join(f"{n} int" for n in names))
    rows = missing.missing_patterns(df.repartition(4), names).orderBy("pattern_id").collect()
    want = [(1, [], 1), (2, ["c69"], 1), (3, ["c33"], 1), (4, ["c00"], 2), (5, ["c00", "c69"], 1)]
    assert [(r["pattern_id"], r["missing_columns"], r["count"]) for r in rows] == want


def table(spark):
    data = {"id": range(6), "left": [3.5, np.nan, 1.5, 8.0, 6.25, 2.0], "right": [np.nan, 12.0, 15.0, 11.0, 19.0, np.nan]}
    return frame(spark, data)


@pytest.mark.parametrize("strategy", ["mean", "median", "most_frequent", "constant", "knn", "iterative_mice", "auto"])
def test_every_strategy_fills_and_flags(spark, strategy, tmp_path):
    df = table(spark)
    cols = ["left", "right"]
    model = MissingImputer(cols, strategy, id_col="id", k=2).fit(df)
    out = model.transform(df)
    assert unfilled(out, cols).count() == 0
    flags = {r["id"]: (r["left_is_na"], r["right_is_na"]) for r in out.collect()}
    assert flags == {0: (0, 1), 1: (1, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (0, 1)}
    model.write().save(str(tmp_path / "m"))
    again = MissingImputerModel.load(str(tmp_path / "m")).transform(df)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_new_missing_columns_are_refused_or_flagged(spark):
    fitted = table(spark).fillna(0.0, ["right"])
    args = dict(columns=["left", "right"], strategy="mean", diagnose=False)
    with pytest.raises(ValueError):
        MissingImputer(**args).fit(fitted).transform(table(spark))
    assert "right_is_na" in MissingImputer(on_new="add", **args).fit(fitted).transform(table(spark)).columns
    assert "right_is_na" not in MissingImputer(on_new="ignore", **args).fit(fitted).transform(table(spark)).columns


def test_an_empty_column_is_left_and_reported(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None)], "id long, a double, b double")
    out = MissingImputer(["a", "b"], "mean", diagnose=False).fit(df).transform(df)
    assert [r["column"] for r in unfilled(out, ["a", "b"]).collect()] == ["a"]


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "x string")
    assert missing.modes(df, ["x"]) == {"x": "a"}


def brute_knn(rows, target, k):
    """Distances to every donor, ties by id."""
    p = rows.shape[1]
    out = rows[:, target].copy()
    donors = np.flatnonzero(~np.isnan(rows[:, target]))
    others = [c for c in range(p) if c != target]
    for i in np.flatnonzero(np.isnan(rows[:, target])):
        gap = rows[donors][:, others] - rows[i, others]
        shared = (~np.isnan(gap)).sum(axis=1)
        d2 = np.where(shared > 0, np.nansum(gap**2, axis=1) * p / np.maximum(shared, 1), np.inf)
        order = np.argsort(d2, kind="stable")[:k]
        order = order[np.isfinite(d2[order])]
        if not len(order):
            out[i] = np.nanmean(rows[:, target])
            continue
        d, v = np.sqrt(d2[order]), rows[donors[order], target]
        out[i] = v[d == 0].mean() if (d == 0).any() else (v / d).sum() / (1 / d).sum()
    return out


@pytest.mark.parametrize("per_block", [4096, 40, 7])
def test_knn_equals_brute_force(spark, per_block):
    rng = np.random.default_rng(5)
    n = 900
    x = np.column_stack([rng.normal(30, 12, n), rng.integers(1, 4, n), rng.integers(0, 3, n), rng.exponential(30, n)])
    x[: n // 3, 1:] = [2.0, 1.0, 8.05]  # a third of the rows at one point
    x[rng.random(n) < 0.2, 0] = np.nan
    x[rng.random(n) < 0.1, 3] = np.nan
    x[5, :] = np.nan
    cols = ["age", "cls", "sib", "fare"]
    df = frame(spark, {"id": np.arange(n), **{c: x[:, i] for i, c in enumerate(cols)}}).repartition(5)
    got = knn.knn_fill(df, df, cols, "id", 5, ["age", "fare"], donors_per_block=per_block).orderBy("id").toPandas()
    assert np.allclose(got["age"], brute_knn(x, 0, 5)) and np.allclose(got["fare"], brute_knn(x, 3, 5))
    assert got["cls"].isna().sum() == np.isnan(x[:, 1]).sum()


def test_knn_fills_new_rows_from_the_fitted_donors(spark):
    donors = spark.createDataFrame([(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 9.0, 90.0)], "id long, a double, b double")
    asked = spark.createDataFrame([(7, 1.5, None), (8, None, None), (9, 2.0, None)], "id long, a double, b double")
    got = {r["id"]: r["b"] for r in knn.knn_fill(asked, donors, ["a", "b"], "id", 2, ["b"]).collect()}
    assert got[7] == pytest.approx(15.0) and got[8] == pytest.approx(40.0) and got[9] == pytest.approx(20.0)


def chain_by_rows(x, rounds=10, tol=1e-3):
    """The same chain, fitted on the completed rows column by column."""
    gone = np.isnan(x)
    means = np.nanmean(x, axis=0)
    y = np.where(gone, means, x)
    order = np.argsort(gone.sum(axis=0), kind="stable")
    for _ in range(rounds):
        before = y.copy()
        for j in order:
            others = [i for i in range(x.shape[1]) if i != j]
            seen = ~gone[:, j]
            z = np.column_stack([np.ones(seen.sum()), y[seen][:, others] - means[others], y[seen, j] - means[j]])
            w, b = mice.bayesian_ridge(z.T @ z)
            if gone[:, j].any():
                y[gone[:, j], j] = (y[gone[:, j]][:, others] - means[others]) @ w + b + means[j]
        if np.abs(y - before).sum(axis=1).max() < tol * np.nanmax(np.abs(x)):
            break
    return y


@pytest.mark.parametrize("on_driver", [True, False])
def test_chain_equals_fitting_on_completed_rows(spark, monkeypatch, on_driver):
    if not on_driver:
        monkeypatch.setattr(patterns, "DRIVER_NUMBERS", 1)
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, (400, 2))
    x = np.column_stack([base[:, 0] * 3 + 100, base @ [1.0, 2.0], base @ [0.5, -1.0] + rng.normal(0, 0.3, 400)])
    for j, share in enumerate((0.2, 0.3, 0.1)):
        x[rng.random(400) < share, j] = np.nan
    x = x[~np.isnan(x).all(axis=1)]
    df = frame(spark, {"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    chain = mice.fit_chain(df, ["a", "b", "c"])
    got = mice.apply_chain(df, chain).orderBy("id").toPandas()[["a", "b", "c"]].to_numpy()
    assert np.allclose(got, chain_by_rows(x), atol=1e-6)


def test_bayesian_ridge_finds_a_clean_line():
    x = np.linspace(0, 1, 200)
    z = np.column_stack([np.ones(200), x, 3 * x - 1])
    w, b = mice.bayesian_ridge(z.T @ z)
    assert w[0] == pytest.approx(3, abs=1e-4) and b == pytest.approx(-1, abs=1e-4)


def test_group_median_only_fills_gaps(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 30.0), (1, None), (2, 5.0), (3, None)], "g int, x double")
    got = sorted((r["g"], r["x"]) for r in missing.fill_group_median(df, missing.group_medians(df, "g", "x"), "g", "x").fillna(-1.0).collect())
    assert got == [(1, 10.0), (1, 20.0), (1, 30.0), (2, 5.0), (3, -1.0)]


def test_patterns_are_one_aggregate(spark):
    df = frame(spark, gappy())
    plan = patterns.pattern_moments(df, ["u", "v", "w"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
