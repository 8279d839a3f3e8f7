"""Table sources and sinks with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.specs import LABELLED_SCHEMA, RAW_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted text; the schema is given, never inferred."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)


def read_raw(spark: SparkSession, train_path: str, test_path: str) -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled) raw records."""
    return read_csv(spark, train_path, LABELLED_SCHEMA), read_csv(spark, test_path, RAW_SCHEMA)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_submission(predictions: DataFrame, id_col: str, path: str, label: str = "Survived") -> None:
    """Id and predicted class as CSV, one file per task."""
    columns = predictions.select(F.col("id").alias(id_col), F.col("prediction").alias(label))
    columns.write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str, sort_by: str, tie: str) -> None:
    """A report table, best rows first, as CSV. The sort is a range-partitioned one, so files are in order."""
    report.orderBy(F.desc(sort_by), F.asc(tie)).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def explode_payload(df: DataFrame, payload: str, item: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Nested batch requests (JSON text of an array of records) to one row per record.

    Unreadable or empty payloads give one row of NULLs, so that no request disappears.
    """
    records = F.from_json(F.col(payload), T.ArrayType(item))
    return df.select(*keep, F.inline_outer(records))
