"""Every registered query with an SQL twin gives DuckDB's rows, names and types."""

import compare
import pytest
from workload import catalog

ORACLES = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def duck(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, duck, name):
    assert compare.differences(QUERIES[name](spark, sf), duck, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark, sf):
    row = catalog.flagship(spark, sf).first()
    assert 0.4 < row["auc"] < 0.7


def test_queries_keep_their_schema_on_empty_tables(spark, sf, tmp_path):
    from pathlib import Path

    for path in Path(sf).glob("*.parquet"):
        spark.read.parquet(str(path)).limit(0).write.parquet(str(tmp_path / path.name))
    for name in ("contract_split", "missing_patterns", "freq_encode", "target_encode", "auc_exact"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0, name
    sweep = QUERIES["threshold_sweep"](spark, str(tmp_path))
    assert sweep.count() == sweep.where("tp + fp + fn + tn = 0 and f1_macro = 0").count() == 41
