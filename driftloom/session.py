"""Session settings, and the shared folder that durable intermediate results go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "driftloom") -> SparkSession:
    """Session for tests and the bench. On a cluster, pass your own session to the operators."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. A folder of our own is made only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="driftloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def durable(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write df as Parquet to the durable folder and read it back.

    Cuts the lineage, survives lost executors, and later readers still prune columns. by: columns of few values, each of which
    gets files of its own, so that a reader of one value does not read the others.
    """
    spark = df.sparkSession
    path = f"{durable_dir(spark)}/{uuid.uuid4().hex}"
    if (paths := _written.get()) is not None:
        paths.append(path)
    df.write.partitionBy(*by).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return stored.select(*[f"`{c}`" for c in df.columns]) if by else stored


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that durable() writes inside are removed at the end. For work whose result has been written elsewhere by then."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
