"""What the physical plans must and must not hold."""

import re
from pathlib import Path

import pytest
from driftloom.operators import ecdf, encode, metrics, patterns
from driftloom.session import durable, durable_dir
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[1]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def scored(spark):
    # a third of the rows share one score
    p = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(1))
    return durable(spark.range(30_000).select("id", p.alias("p"), (F.rand(2) < F.col("p")).cast("int").alias("y")))


def test_areas_use_many_buckets_and_one_scan(scored):
    plan = final_plan(metrics.ranking_metrics(scored, "y", "p", rows_per_bucket=1000))
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("ReusedExchange") >= 1 and plan.count("FileScan") == 1


def test_the_hot_value_is_one_row_before_the_sort(scored):
    counts = ecdf.value_counts(scored, ["p"], ecdf.profile(scored, ["p"], rows_per_bucket=1000).splits, {"n": F.lit(1)})
    assert counts.where("n > 1").count() == 1 and counts.agg(F.max("n")).first()[0] == 10_000
    assert counts.groupBy("bucket").count().agg(F.max("count")).first()[0] < 2_500


def test_only_the_needed_columns_are_read(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_shipdate < timestamp'1998-01-01'")
    plan = final_plan(encode.key_counts(items, "l_partkey"))
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(l_" in plan


def test_sweep_and_patterns_combine_before_the_shuffle(scored):
    for df in (metrics.threshold_sweep(scored, "y", "p", [0.2, 0.5]), patterns.pattern_moments(scored, ["p", "y"])):
        plan = final_plan(df)
        assert "partial_" in plan and "CartesianProduct" not in plan


def test_the_durable_folder_is_the_configured_one(spark):
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if wanted:
        assert durable_dir(spark) == wanted
    else:
        assert spark.sparkContext.getCheckpointDir() == durable_dir(spark)


def test_library_rules():
    """No whole-row Python functions, local checkpoints, cross joins or RDD code in the library."""
    for path in (ROOT / "driftloom").rglob("*.py"):
        if "llm" in path.parts:
            continue  # numbers rows of tables that it has stored
        text = path.read_text()
        assert not re.search(r"\.rdd\b|localCheckpoint|crossJoin|F\.udf|@udf|monotonically_increasing_id", text), path


def test_a_stored_table_is_read_by_the_value_that_is_asked_for(spark):
    rows = [(i, [0, 1, None][i % 3], float(i), f"x.{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "id long, fit int, `a.b` double, c string")
    stored = durable(df.repartition(1), ["fit"])
    assert stored.schema == df.schema and sorted(stored.collect(), key=lambda r: r[0]) == [*map(tuple, rows)]
    plan = final_plan(stored.where("fit = 1"))
    assert "PartitionFilters: [isnotnull(fit" in plan and stored.where("fit = 1").count() == 10
    assert len({f.split("fit=")[1].split("/")[0] for f in stored.inputFiles()}) == 3
    assert sorted(durable(df).collect(), key=lambda r: r[0]) == [*map(tuple, rows)]
