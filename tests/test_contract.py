import pytest
from driftloom.operators import contract
from driftloom.sources import tables
from driftloom.specs import LABELLED_SCHEMA, RAW_SCHEMA, FieldRule

GOOD = (1, 1, "Cumings, Mrs. John", "  MALE  ", 38.0, 1, 0, "PC 17599", 71.28, "C85", "  c  ")


def records(spark, *rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def changed(**fields):
    row = dict(zip(RAW_SCHEMA.names, GOOD), **fields)
    return tuple(row[n] for n in RAW_SCHEMA.names)


def test_text_is_normalised(spark):
    valid, bad = contract.split(records(spark, GOOD))
    assert valid.select("Sex", "Embarked").first() == ("male", "C") and bad.count() == 0


@pytest.mark.parametrize(
    "fields,rule",
    [
        ({"Sex": "alien"}, "Sex:enum"),
        ({"Pclass": 5}, "Pclass:enum"),
        ({"Embarked": "X"}, "Embarked:enum"),
        ({"Age": -1.0}, "Age:range"),
        ({"Age": 121.0}, "Age:range"),
        ({"Fare": 1000.5}, "Fare:range"),
        ({"Name": "x"}, "Name:length"),
        ({"Name": None}, "Name:missing"),
        ({"SibSp": 21}, "SibSp:range"),
        ({"Cabin": "c" * 51}, "Cabin:length"),
    ],
)
def test_bad_rows_are_set_aside_and_good_ones_kept(spark, fields, rule):
    valid, bad = contract.split(records(spark, GOOD, changed(**fields)))
    assert valid.count() == 1 and rule in bad.first()["violations"]
    assert rule in [r["rule"] for r in contract.violation_summary(bad).collect()]


def test_optional_fields_and_defaults(spark):
    row = changed(Age=None, Fare=float("nan"), Cabin=None, Embarked=None, Ticket=None)
    valid, _ = contract.split(records(spark, row))
    got = valid.first()
    assert got["Embarked"] == "S" and got["Fare"] is None and got["Ticket"] is None
    absent = records(spark, GOOD).drop("PassengerId", "SibSp", "Parch", "Ticket", "Embarked")
    got = contract.split(absent)[0].first()
    assert (got["PassengerId"], got["SibSp"], got["Parch"], got["Ticket"], got["Embarked"]) == (1, 0, 0, "PC 17599", "S")
    filled = contract.normalise(records(spark, row), fill="null").first()
    assert filled["Ticket"] == "PC 17599"


def test_cross_field_rule(spark):
    from pyspark.sql import functions as F

    rules = (FieldRule("a"), FieldRule("b"))
    df = spark.createDataFrame([(1, 2), (3, 2), (None, 2)], "a int, b int")
    valid, bad = contract.split(df, rules, {"ordered": F.col("a") <= F.col("b")})
    assert valid.count() == 2 and bad.first()["violations"] == ["ordered"]


def test_empty_batch(spark):
    empty = records(spark, GOOD).limit(0)
    with pytest.raises(ValueError):
        contract.refuse_empty(empty)
    valid, bad = contract.split(empty)
    assert valid.count() == 0 and set(RAW_SCHEMA.names) <= set(valid.columns) and "violations" in bad.columns


def test_csv_with_quotes_and_missing_fields(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        ",".join(LABELLED_SCHEMA.names) + '\n1,0,3,"Braund, Mr. ""Owen"" Harris",male,22,1,0,A/5 21171,7.25,,S\n2,1,1,"X, Mrs. Y",female,,1,0,PC 17599,,C85,\n'
    )
    df, _ = tables.read_raw(spark, str(path), str(path).replace("raw", "*"))
    first, second = df.orderBy("PassengerId").collect()
    assert first["Name"] == 'Braund, Mr. "Owen" Harris' and first["Cabin"] is None and first["Age"] == 22.0
    assert second["Age"] is None and second["Embarked"] is None and second["Survived"] == 1


def test_payload_rows(spark):
    df = spark.createDataFrame([("r1", '[{"PassengerId": 1, "Age": 2.5}, {"PassengerId": 2}]'), ("r2", "broken")], "req string, body string")
    got = tables.explode_payload(df, "body", RAW_SCHEMA, ["req"]).select("req", "PassengerId", "Age").collect()
    assert sorted(map(tuple, got), key=str) == [("r1", 1, 2.5), ("r1", 2, None), ("r2", None, None)]
