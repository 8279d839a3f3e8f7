"""Stream sources over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Micro-batches of the files that arrive in a folder, with a fixed schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
