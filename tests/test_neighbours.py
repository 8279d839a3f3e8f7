"""The space tree of the neighbour search: how much it exchanges, and what a fitted one reads."""

import numpy as np
import pandas as pd
import pytest
from driftloom.operators import knn
from pyspark.sql import functions as F
from test_imputation import brute_knn

COLS = list("abcdef")


def table(spark, n, seed, gaps=0.3):
    r = np.random.default_rng(seed)
    x = r.normal(0, 1, (n, 6)) * np.array([10, 1, 2, 5, 3, 20])
    x[r.random(n) < gaps, 0] = np.nan
    x[r.random(n) < 0.1, 5] = np.nan
    return x, spark.createDataFrame(pd.DataFrame({"id": np.arange(n), **{c: x[:, i] for i, c in enumerate(COLS)}}))


def asked_rows(monkeypatch, run):
    """Rows that receivers send to leaves, over both rounds."""
    sent, search = [], knn._search
    monkeypatch.setattr(knn, "_search", lambda asked, *more: (sent.append(asked.count()), search(asked, *more))[1])
    out = run()
    return sum(sent), out


def test_six_inputs_with_gaps_ask_few_leaves(spark, monkeypatch):
    x, df = table(spark, 3000, 1)
    tables = knn.fit(df, COLS, "id", 5, ["a"], donors_per_block=32)
    leaves = tables["leaves_a"].count()
    sent, out = asked_rows(monkeypatch, lambda: knn.fill(df, tables, COLS, "id", 5, ["a"], donors_per_block=32).orderBy("id").toPandas())
    assert np.allclose(out["a"], brute_knn(x, 0, 5))
    receivers = int(np.isnan(x[:, 0]).sum())
    assert leaves > 60 and sent < receivers * leaves / 2


def test_what_is_exchanged_grows_with_the_receivers(spark, monkeypatch):
    _, donors = table(spark, 4000, 2, 0.0)
    tables = knn.fit(donors, COLS, "id", 3, ["a"], donors_per_block=64)
    counts = []
    for n in (200, 800):
        _, new = table(spark, n, 3, 1.1)
        counts.append(asked_rows(monkeypatch, lambda: knn.fill(new, tables, COLS, "id", 3, ["a"], donors_per_block=64).count())[0])
    assert counts[1] < 5 * counts[0]


def test_a_second_fill_neither_reads_nor_writes_the_donors(spark, monkeypatch):
    _, df = table(spark, 300, 4)
    tables = knn.fit(df, COLS, "id", 5, ["a"])
    written, durable = [], knn.durable
    monkeypatch.setattr(knn, "durable", lambda d: (written.append(d.columns), durable(d))[1])
    first = knn.fill(df, tables, COLS, "id", 5, ["a"]).orderBy("id").collect()
    assert first == knn.fill(df, tables, COLS, "id", 5, ["a"]).orderBy("id").collect()
    assert written and not any("value" in c and "point" not in c for c in written)


def test_tree_cuts_in_halves_and_survives_ties_and_gaps():
    r = np.random.default_rng(0)
    x = r.normal(0, 1, (1000, 3))
    x[:400, :] = 1.0
    x[r.random(1000) < 0.2, 1] = np.nan
    column, cut = knn.grow(x, 20, 64)
    leaves = np.unique(knn.leaf_number(x, column, cut), return_counts=True)[1]
    assert len(leaves) > 16 and np.sort(leaves)[-2] < 100
    assert len(knn.grow(np.ones((50, 2)), 1, 64)[0]) and (knn.grow(np.ones((50, 2)), 1, 64)[0] == -1).all()
    assert (knn.leaf_number(x, *knn.grow(x, 2000, 64)) == 0).all()


def test_box_distances_are_bounds():
    r = np.random.default_rng(1)
    for _ in range(30):
        a, b = r.normal(0, 2, (5, 3)), r.normal(0, 2, (7, 3))
        a[r.random(a.shape) < 0.2] = np.nan
        b[:, r.random(3) < 0.3] = np.nan
        low, high = b.min(0)[None], b.max(0)[None]
        bound, d2 = knn.box_distances(a, low, high, 4)[:, 0], knn.squared_distances(a, b, 4)
        assert (bound <= d2.min(1) + 1e-12).all()


@pytest.mark.parametrize("rows", [[], [(1, 1.0, None)]])
def test_nothing_to_learn_from(spark, rows):
    donors = spark.createDataFrame(rows, "id long, a double, b double")
    new = spark.createDataFrame([(5, 1.0, None), (6, None, 2.0)], "id long, a double, b double")
    got = {r["id"]: (r["a"], r["b"]) for r in knn.knn_fill(new, donors, ["a", "b"], "id").collect()}
    assert got[5] == (1.0, None) and got[6][1] == 2.0
    assert knn.knn_fill(new.limit(0), donors, ["a", "b"], "id").count() == 0


def test_further_columns_with_the_names_in_use(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, "x", 9), (2, 1.1, None, "y", 8)], "id long, a double, b double, leaf string, n int")
    got = knn.knn_fill(df, df, ["a", "b"], "id").where(F.col("id") == 2).first()
    assert tuple(got) == (2, 1.1, 5.0, "y", 8)


@pytest.mark.parametrize("kind", ["spread", "few values", "some of each"])
def test_the_tree_of_a_leaf_finds_what_brute_force_finds(kind):
    """With ties, missing columns on both sides, fewer donors than k, and columns of few values."""
    r = np.random.default_rng(8)
    draw = {"spread": lambda s: r.normal(0, 1, s), "few values": lambda s: r.integers(0, 3, s).astype(float),
            "some of each": lambda s: np.where(np.arange(s[1]) % 2, r.integers(0, 3, s), r.normal(0, 1, s))}[kind]
    for n, f, k in ((3, 2, 5), (40, 1, 3), (400, 3, 5), (900, 5, 1)):
        donors, x, ranks = draw((n, f)), draw((50, f)), r.permutation(n)
        x[r.random(x.shape) < 0.2] = np.nan
        donors[:, 1:2] = np.nan if f == 3 else donors[:, 1:2]
        row, donor, d = knn.nearest(x, donors, ranks, k, f + 1)
        far = np.sqrt(knn.squared_distances(x, donors, f + 1))
        for i in range(len(x)):
            order = np.lexsort((ranks, far[i]))
            order = order[np.isfinite(far[i][order])][:k]
            assert (donor[row == i] == order).all() and (d[row == i] == far[i][order]).all()


def test_receivers_are_not_held_against_all_leaves(spark, monkeypatch):
    """The nearest leaf, and those within reach, come from a tree over the boxes: comparisons stay far below receivers x leaves."""
    r = np.random.default_rng(9)
    corner = np.stack(np.meshgrid(np.arange(40.0), np.arange(40.0)), -1).reshape(-1, 2)
    table = spark.createDataFrame(
        [(f"{i % 2}:00:{i}", i % 2, 50, [*map(float, c)], [*map(float, c + 0.9)]) for i, c in enumerate(corner)], "leaf string, part long, n long, low array<double>, high array<double>"
    )
    leaves, held, apart = knn._Leaves(table, 2, 5, 3), [], knn._Tree.apart
    monkeypatch.setattr(knn._Tree, "apart", lambda self, x, *more: (held.append(len(x)), apart(self, x, *more))[1])
    x, part, limit = r.random((500, 2)) * 40, r.integers(0, 2, 500), np.full(500, 0.7)
    home, found = leaves.home(x, part), leaves.within(x, part, limit, -1)
    assert sum(held) < 500 * 800 / 4
    names = {name: i for i, name in enumerate(leaves.names)}
    far = np.sqrt(knn.box_distances(x, leaves.low, leaves.high, 3))
    of = np.array([int(name[0]) for name in names])
    far[part[:, None] != of[None, :]] = np.inf
    assert all((np.flatnonzero(far[i] <= 0.7) == found[i]).all() for i in range(500)) and (of[home] == part).all()


def test_only_rows_with_a_gap_are_joined_where_many_points_are_filled(spark, monkeypatch):
    x, df = table(spark, 600, 10)
    tables = knn.fit(df, COLS, "id", 5, ["a", "f"])
    want = knn.fill(df, tables, COLS, "id", 5, ["a", "f"]).orderBy("id").toPandas()
    joined, join = [], knn.lookup_join
    monkeypatch.setattr(knn, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(knn, "lookup_join", lambda left, *more: (joined.append(left.count()), join(left, *more))[1])
    got = knn.fill(df, tables, COLS, "id", 5, ["a", "f"]).orderBy("id").toPandas()
    assert set(joined) == {int((np.isnan(x[:, 0]) | np.isnan(x[:, 5])).sum())}
    assert [*got.columns] == [*want.columns] and np.allclose(got, want, equal_nan=True)


def test_missing_and_repeated_ids(spark):
    """Of the donors at one point the first k stay, missing ids before others and rows of one id in the order of their values."""
    donors = spark.createDataFrame([(None, 1.0, 9.0), (7, 1.0, 3.0), (7, 1.0, 5.0), (2, 4.0, 8.0)], "id long, a double, b double")
    new = spark.createDataFrame([(1, 1.0, None), (None, 4.0, None)], "id long, a double, b double")
    got = {r["a"]: r["b"] for r in knn.knn_fill(new, donors, ["a", "b"], "id", 2, ["b"]).collect()}
    assert got[4.0] == 8.0 and got[1.0] == 6.0
