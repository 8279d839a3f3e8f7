import numpy as np
import pytest
from driftloom.operators import ecdf, folds, governance, metrics
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(4000):
        x = 5.0 if i % 3 == 0 else float(np.round(rng.normal(0, 10), 2))
        y = None if i % 11 == 0 else (float("nan") if i % 13 == 0 else float(rng.exponential(3)))
        rows.append((i, "abc"[i % 3] if i % 97 else None, x, y, int(rng.random() < 0.4)))
    return rows, spark.createDataFrame(rows, "id long, g string, x double, y double, label int").repartition(7)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 300, 40])
def test_percentiles_equal_numpy(sample, rows_per_bucket):
    rows, df = sample
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r["column"]: r for r in ecdf.percentiles(df, ["x", "y"], probs, rows_per_bucket=rows_per_bucket).collect()}
    for k, name in ((2, "x"), (3, "y")):
        values = np.array([r[k] for r in rows if r[k] is not None and r[k] == r[k]])
        assert got[name]["n"] == len(values)
        assert np.allclose(got[name]["quantiles"], np.quantile(values, probs), rtol=1e-12)


@pytest.mark.parametrize("rows_per_bucket", [10**6, 100])
def test_percentiles_by_group(sample, rows_per_bucket):
    rows, df = sample
    got = ecdf.percentiles(df, ["x"], [0.1, 0.5], by=["g"], rows_per_bucket=rows_per_bucket).collect()
    assert {r["g"] for r in got} == set("abc")
    for r in got:
        values = [v[2] for v in rows if v[1] == r["g"]]
        assert np.allclose(r["quantiles"], np.quantile(values, [0.1, 0.5]))


def areas(rows):
    """Direct counting over all pairs, and average precision by descending score."""
    pos = np.array([x for x, y in rows if y == 1])
    neg = np.array([x for x, y in rows if y == 0])
    auc = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    ap = sum((pos == t).sum() / len(pos) * (pos >= t).sum() / ((pos >= t).sum() + (neg >= t).sum()) for t in set(pos))
    return auc, ap


@pytest.mark.parametrize("rows_per_bucket", [10**6, 150])
def test_areas_equal_pair_counting(sample, rows_per_bucket):
    rows, df = sample
    row = metrics.ranking_metrics(df, "label", "x", rows_per_bucket=rows_per_bucket).first()
    auc, ap = areas([(r[2], r[4]) for r in rows])
    assert row["auc"] == pytest.approx(auc, abs=1e-12) and row["pr_auc"] == pytest.approx(ap, abs=1e-12)
    for r in metrics.ranking_metrics(df, "label", "x", ["g"], rows_per_bucket=rows_per_bucket).collect():
        assert r["auc"] == pytest.approx(areas([(v[2], v[4]) for v in rows if v[1] == r["g"]])[0], abs=1e-12)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.2, 1), (0.4, 1)], "p double, y int")
    assert metrics.ranking_metrics(df, "y", "p").first()["auc"] is None


@pytest.mark.parametrize("rows_per_bucket", [10**6, 90])
def test_row_ranks(sample, rows_per_bucket):
    rows, df = sample
    got = {r["id"]: r["rank"] for r in ecdf.row_ranks(df, "id", ["g"], rows_per_bucket=rows_per_bucket).collect()}
    truth, seen = {}, {}
    for r in rows:
        truth[r[0]] = seen.get(r[1], 0)
        seen[r[1]] = truth[r[0]] + 1
    assert got == truth


@pytest.mark.parametrize("seed", [None, 1, 42])
def test_folds_are_even_per_class_even_with_one_dominant_class(sample, seed):
    _, df = sample
    skewed = df.select("id", (F.col("id") % 50 == 0).cast("int").alias("y"))
    assigned = folds.stratified_folds(skewed, "y", "id", 5, seed, rows_per_bucket=100)
    sizes = assigned.groupBy("y", "fold").count().collect()
    assert assigned.count() == 4000 and len(sizes) == 10
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert max(counts) - min(counts) <= 1


def test_seeds_give_different_folds_and_the_same_seed_the_same(sample):
    _, df = sample
    a, b, c = (
        {r["id"]: r["fold"] for r in folds.stratified_folds(df, "label", "id", 5, s).collect()} for s in (1, 1, 2)
    )
    assert a == b != c


def replay(versions, least):
    """The registry rule, one version after the other."""
    champion = previous = None
    out = {}
    for v, auc in versions:
        auc = auc or 0.0
        won = auc >= least and (champion is None or auc > champion[1])
        if won:
            previous = champion[0] if champion else None
            champion = (v, auc)
        out[v] = (won, previous if won else None, champion[0] if champion else None)
    return out


@pytest.mark.parametrize("rows_per_bucket", [10**6, 20])
def test_promotion_history_equals_a_replay(spark, rows_per_bucket):
    rng = np.random.default_rng(3)
    versions = [(i, None if i % 17 == 0 else float(np.round(0.85 + 0.1 * rng.random() * (i / 300), 4))) for i in range(1, 300)]
    df = spark.createDataFrame(versions, "version long, auc double")
    got = governance.promotion_history(df, rows_per_bucket=rows_per_bucket).collect()
    assert {r["version"]: (r["is_champion"], r["previous_champion"], r["champion_now"]) for r in got} == replay(versions, 0.88)


@pytest.mark.parametrize("grid", [metrics.WIDE_GRID, metrics.NARROW_GRID])
def test_sweep_equals_a_pass_per_threshold(sample, grid):
    rows, df = sample
    points = metrics.grid(*grid)
    scored = df.select((F.abs("x") / 30).alias("p"), "label")
    p = np.array([abs(r[2]) / 30 for r in rows])
    y = np.array([r[4] for r in rows])
    got = metrics.threshold_sweep(scored, "label", "p", points).orderBy("idx").collect()
    assert [r["threshold"] for r in got] == points
    for r in got:
        d = p >= r["threshold"]
        assert (r["tp"], r["fp"], r["fn"], r["tn"]) == ((d & (y == 1)).sum(), (d & (y == 0)).sum(), (~d & (y == 1)).sum(), (~d & (y == 0)).sum())


def test_grids_are_the_published_ones():
    assert len(metrics.grid(*metrics.NARROW_GRID)) == 41 and len(metrics.grid(*metrics.WIDE_GRID)) == 80
    assert metrics.grid(*metrics.NARROW_GRID)[-1] == 0.7000000000000004


def test_no_task_sees_a_whole_column(sample):
    _, df = sample
    table = metrics.ranking_metrics(df, "label", "x", ["g"], rows_per_bucket=100)
    table.collect()
    assert "SinglePartition" not in table._jdf.queryExecution().executedPlan().toString()
