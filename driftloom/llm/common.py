"""Helpers that the operators of this folder share: stored steps, UTF-8 buffers of Arrow columns, rolling hashes."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.session import durable_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Bytes that a kernel works on at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
# Bytes that a kernel with many numbers per byte works on at once: some 100 bytes a byte, in each worker of an executor.
SLICE_BYTES = 1 << 18
# A table is broadcast only after its rows have been counted and are at most this many (of a few numbers each).
BROADCAST_ROWS = 200_000
# Fixed odd multipliers of the hashes below.
POWER = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Steps:
    """Tables that one call writes to the durable folder. `drop` removes those that no result reads."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, f"{durable_dir(spark)}/llm-{uuid.uuid4().hex}", {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write and read again: cuts the lineage and survives lost executors."""
        path = f"{self.folder}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = path
        out._step = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(table._step)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


# Rows and bytes of an Arrow batch, where the session has Spark's defaults: a batch of long texts must stay small.
BATCH_ROWS, ARROW_BYTES = 1000, 8 << 20


def small_batches() -> None:
    """Set the session's Arrow batch limits, unless the user has set others."""
    conf = SparkSession.active().conf
    for name, default, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20), ARROW_BYTES),
    ):
        if conf.get(name, default) in (default, f"{default}b"):
            conf.set(name, str(value))


def release() -> None:
    """Give memory that is free back to the system: workers live on after a task, and what they keep is their executor's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def kernel(function, kind: str):
    """An Arrow function on columns, in small batches; it keeps no free memory from one batch to the next."""
    small_batches()

    @functools.wraps(function)
    def run(*columns):
        out = function(*columns)
        release()
        return out

    return F.arrow_udf(run, kind)


def lowered(text: Column) -> Column:
    """A-Z in lower case, other characters as they are; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def small_enough(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    return df.limit(most + 1).count() <= most


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if its counted rows are few; otherwise the join shuffles."""
    return F.broadcast(df) if small_enough(df, most) else df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and the n + 1 places where texts begin and end; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold at most `most` bytes, or a single longer text."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}
# Entries of the tables that a process keeps; longer ones are made for the call.
KEPT_POWERS = 2 * BATCH_BYTES


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """POWER ** i and its inverse modulo 2 ** 64, for i < n at least."""
    if len(_powers.get("up", ())) < n:
        size = -(-n // 65_536) * 65_536
        inverse = np.uint64(pow(int(POWER), -1, 1 << 64))
        tables = {}
        for name, base in (("up", POWER), ("down", inverse)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables[name] = np.multiply.accumulate(table, out=table)
        if size > KEPT_POWERS:
            return tables["up"], tables["down"]
        _powers.update(tables)
    return _powers["up"], _powers["down"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H, such that span_hash(H, a, b) is a hash of data[a:b] that doesn't depend on the place."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start])
