"""Queries of the corpus operators that SQL can express give DuckDB's rows; all keep their schema on empty tables."""

from pathlib import Path

import compare
import pytest

from driftloom.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf, duck, name):
    assert compare.differences(queries.QUERIES[name](spark, sf), duck, queries.ORACLES[name]) == []


def test_all_operators_and_the_pipeline_are_registered():
    names = {n.split("_")[0] for n in queries.QUERIES}
    assert names == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.fixture(scope="module")
def nothing(spark, sf, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for path in Path(sf).glob("*.parquet"):
        spark.read.parquet(str(path)).limit(0).write.parquet(str(folder / path.name))
    return str(folder)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, sf, nothing, name):
    got = queries.QUERIES[name](spark, nothing)
    assert got.count() == (1 if name == "op2_chat" else 0)  # conversation -7 belongs to the query
