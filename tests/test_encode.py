import numpy as np
import pytest
from driftloom.operators import encode, parse
from pyspark.sql import functions as F


def test_unseen_category_gets_the_global_mean(spark):
    fit = spark.createDataFrame(list(zip("AAABBC", (1, 1, 0, 0, 0, 1))), "Category string, Target int")
    table = encode.target_encoding(fit, ["Category"], "Target", 10.0)
    new = spark.createDataFrame([("A",), ("B",), ("UNKNOWN",), (None,)], "Category string")
    got = {r["Category"]: r["Category_TE"] for r in encode.apply_target_encoding(new, table, ["Category"], 0.5).collect()}
    assert got["UNKNOWN"] == got[None] == 0.5
    assert got["A"] == pytest.approx((2 + 5) / 13) and got["B"] == pytest.approx(5 / 12)


def test_rare_categories_shrink_more(spark):
    rows = [("RARE", 1)] + [("FREQUENT", int(i < 80)) for i in range(100)]
    df = spark.createDataFrame(rows, "c string, y int")
    got = {r["category"]: r["encoding"] for r in encode.target_encoding(df, ["c"], "y", 10.0).collect()}
    prior = 81 / 101
    assert abs(got["RARE"] - prior) < 0.05 and abs(got["FREQUENT"] - 0.8) < 0.01


def test_missing_is_a_category(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 0)], "c string, y int")
    got = {r["category"]: r["n"] for r in encode.target_encoding(df, ["c"], "y").collect()}
    assert got == {"nan": 2, "a": 1}


def test_fold_encoding_equals_a_fit_per_fold(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "hot" if i % 3 == 0 else f"c{rng.integers(0, 40)}", int(rng.random() < 0.4), i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, c string, y int, fold int")
    table = encode.fold_encoding(df, ["c"], "y", "fold", 10.0)
    got = {r["id"]: r["c_TE"] for r in encode.apply_fold_encoding(df, table, ["c"], "fold").collect()}
    for i, c, _, f in rows:
        rest = [(a, y) for _, a, y, g in rows if g != f]
        prior = sum(y for _, y in rest) / len(rest)
        mine = [y for a, y in rest if a == c]
        assert got[i] == pytest.approx((sum(mine) + 10 * prior) / (len(mine) + 10) if mine else prior, abs=1e-12)


def test_own_label_does_not_reach_the_encoding(spark):
    df = spark.createDataFrame([(i, f"c{i}", i % 2, i % 5) for i in range(50)], "id long, c string, y int, fold int")
    table = encode.fold_encoding(df, ["c"], "y", "fold")
    out = encode.apply_fold_encoding(df, table, ["c"], "fold")
    assert out.groupBy("fold").agg(F.count_distinct("c_TE").alias("k")).where("k > 1").count() == 0


def test_effective_folds(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (0,), (0,)], "y int")
    assert encode.effective_folds(df, "y", 5) == 2
    assert encode.effective_folds(df.where("y = 1"), "y", 5) == 0


def test_one_hot_and_alignment(spark):
    fit = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "c string, k int")
    categories = encode.freeze_categories(fit, ["c"])
    assert categories == {"c": ["a", "b", "nan"]}
    new = spark.createDataFrame([("b", 1), ("zzz", 2)], "c string, k int")
    wide = encode.one_hot(new, categories)
    assert [tuple(r) for r in wide.orderBy("k").collect()] == [(1, 1, 0), (2, 0, 0)]
    assert encode.align(wide, ["c_nan", "more", "k"]).columns == ["c_nan", "more", "k"]
    with pytest.raises(ValueError):
        encode.select_columns(new, ["nope"], strict=True)
    assert encode.freeze_categories(fit, ["c", "k"], most=2) == {}
    assert set(encode.freeze_categories(fit.where("k > 1"), ["c", "k"], most=2)) == {"c", "k"}


@pytest.mark.parametrize("known", [None, 10])
def test_wide_columns_are_numbered(spark, known):
    fit = spark.createDataFrame([(f"v{i % 700:03d}",) for i in range(2000)] + [(None,)], "c string")
    table = encode.category_index(fit, "c")
    rows = {r["category"]: (r["index"], r["n"]) for r in table.collect()}
    assert [rows[k][0] for k in sorted(rows)] == list(range(701)) and sum(n for _, n in rows.values()) == 2001
    new = spark.createDataFrame([("v003",), ("zzz",), (None,)], "c string")
    got = {r["c"]: r["c_index"] for r in encode.apply_category_index(new, table, "c", known).collect()}
    assert got == {"v003": rows["v003"][0], "zzz": -1, None: rows["nan"][0]}


def test_string_rules(spark):
    rows = [
        ("Cumings, Mrs. John", "A/5. 21171", "C85"),
        ("Noname", None, "  "),
        ("X, the Countess. of", "PC 17599", "f g73"),
        ("Z, Mr. Q", "LINE", None),
        ("Z, Mr. Q", "330911", None),
        ("Z, Mlle. Q", "", "B5"),
        (None, "\tS.O./P.P. 3 ", "\t\n"),
    ]
    df = spark.createDataFrame(rows, "n string, t string, c string")
    got = df.select(parse.group_rare(parse.courtesy_title("n")), parse.code_prefix("t"), parse.first_letter("c")).collect()
    assert [tuple(r) for r in got] == [
        ("Mrs", "A5", "C"),
        ("Rare", "NUMERIC", "U"),
        ("Rare", "PC", "F"),
        ("Mr", "LINE", "U"),
        ("Mr", "NUMERIC", "U"),
        ("Miss", "NUMERIC", "B"),
        ("Rare", "SOPP", "U"),
    ]


def test_frequency_counts_skip_missing_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id long, k string")
    got = {r["id"]: r["f"] for r in encode.frequency_encode(df, encode.key_counts(df, "k"), "k", "f").collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: 1}


def test_categories_are_read_once_and_wide_columns_left_out(spark, monkeypatch):
    df = spark.range(60).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).cast("string").alias("b"), F.col("id").alias("wide"))
    stored, durable = [], encode.durable
    monkeypatch.setattr(encode, "durable", lambda d: (stored.append(sorted(map(tuple, d.collect()))), durable(d))[1])
    assert encode.freeze_categories(df, ["a", "b", "wide"], 10) == {"a": ["0", "1", "2"], "b": ["1", "2", "3", "nan"]}
    assert len(stored) == 1 and len(stored[0]) == 3 + 4 + 60
