"""Isotonic regression by ranges against pooling all points in one go."""

import numpy as np
import pandas as pd
import pytest
from driftloom.operators import isotonic
from pyspark.sql import functions as F


def plain(s, y, w):
    """Blocks (low, high, value) by pooling adjacent violators over all points."""
    out = []
    for i in np.argsort(s, kind="stable"):
        out.append([s[i], s[i], y[i] * w[i], w[i]])
        while len(out) > 1 and out[-2][2] / out[-2][3] >= out[-1][2] / out[-1][3] - 1e-12:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    return [(a, b, t / n) for a, b, t, n in out]


def step(blocks, x):
    return np.array([next(v for a, b, v in blocks if a <= q <= b) for q in x])


def cases():
    r = np.random.default_rng(3)
    s = np.sort(r.random(600))
    yield "noise", s, (r.random(600) < s).astype(float), np.ones(600)
    yield "falling", s, 1 - s, np.ones(600)
    yield "rising", s, s, r.integers(1, 9, 600).astype(float)
    yield "heavy", s, (r.random(600) < s).astype(float), np.where(r.random(600) < 0.02, 1e6, 1.0)
    yield "a heavy low end at the right", s, np.where(np.arange(600) > 590, 0.01, s), np.where(np.arange(600) > 590, 1e5, 1.0)
    yield "constant", s, np.full(600, 0.25), np.ones(600)
    yield "one", s[:1], np.array([1.0]), np.ones(1)


@pytest.mark.parametrize("case", cases(), ids=lambda c: c[0])
@pytest.mark.parametrize("per_range", [200_000, 25])
def test_same_function_as_pooling_all_points(spark, case, per_range):
    _, s, y, w = case
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y, "w": w})).repartition(4)
    got = [(r["low"], r["high"], r["value"]) for r in isotonic.fit_isotonic(df, "s", "y", "w", per_range).orderBy("low").collect()]
    want = plain(s, y, w)
    assert np.allclose(step(got, s), step(want, s), atol=1e-9)
    assert all(a[1] < b[0] and a[2] <= b[2] + 1e-9 for a, b in zip(got, got[1:]))


def test_map_is_linear_between_blocks_and_flat_outside(spark):
    r = np.random.default_rng(1)
    s = np.sort(r.random(400))
    y = (r.random(400) < s).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y, "w": np.ones(400)}))
    table, edges = isotonic.lay_out(isotonic.fit_isotonic(df, "s", "y", "w", 50))
    blocks = plain(s, y, np.ones(400))
    knots = [(k, v) for a, b, v in blocks for k in ((a,) if a == b else (a, b))]
    x = np.concatenate([s, r.random(300), [-5.0, 7.0, 0.0, 1.0]])
    asked = spark.createDataFrame(pd.DataFrame({"s": x, "bucket": "mine"}))
    want = np.interp(x, [k for k, _ in knots], [v for _, v in knots])
    for known in (0, 10**9):  # both joins
        got = isotonic.apply_map(asked, table, edges, "s", "p", known).toPandas()
        assert len(got) == len(x) and list(got.columns) == ["s", "bucket", "p"]
        assert np.allclose(got.sort_values("s").p, want[np.argsort(x)], atol=1e-9)


def test_missing_scores_weights_and_empty_tables(spark):
    rows = [(0.1, 0.0, 1.0), (0.5, 1.0, 1.0), (None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (0.7, None, 1.0), (0.9, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "s double, y double, w double")
    fitted = isotonic.fit_isotonic(df, "s", "y", "w")
    assert sorted(map(tuple, fitted.collect())) == [(0.1, 0.1, 0.0, 1.0), (0.5, 0.5, 1.0, 1.0)]
    table, edges = isotonic.lay_out(fitted)
    asked = spark.createDataFrame([(1, 0.3), (2, None), (3, float("nan")), (4, 99.0), (4, 99.0)], "id int, s double")
    got = sorted((r["id"], r["p"]) for r in isotonic.apply_map(asked, table, edges, "s", "p", 2).where("p is not null").collect())
    assert got == [(1, pytest.approx(0.5)), (4, 1.0), (4, 1.0)]
    nothing, edges = isotonic.lay_out(isotonic.fit_isotonic(df.limit(0), "s", "y", "w"))
    assert isotonic.apply_map(asked, nothing, edges, "s", "p", 0).where(F.col("p").isNull()).count() == 5
