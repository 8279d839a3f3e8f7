"""Event-time drift windows and duplicate suppression. The same functions work on batch frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import bucket_index, nan_to_null
from driftloom.operators.drift import Baseline, psi_from_counts
from driftloom.specs import DriftLimits


def event_time(df: DataFrame, ts: str, delay: str | None = None) -> DataFrame:
    """Event time as TIMESTAMP (a watermark does not take the zone-less kind), with a watermark if asked for."""
    typed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return typed.withWatermark(ts, delay) if delay else typed


def window_psi(
    df: DataFrame, ts: str, value: str, baseline: Baseline, window: Column, by: Sequence[str] = (), limits: DriftLimits = DriftLimits()
) -> DataFrame:
    """(window_start, window_end, by..., n, psi): drift of one score per event-time window.

    `window` is F.window(...) or F.session_window(...). The bins are fixed by the baseline, so a window is
    one aggregate with one counter per bin, and PSI is an expression on that row. Rows later than the
    watermark are left out by the stream.
    """
    b = bucket_index(nan_to_null(value), list(baseline.edges))
    counters = [F.count_if(F.col("__bin") == i).alias(f"__n{i}") for i in range(baseline.bins)]
    counted = df.withColumn("__bin", b).groupBy(window.alias("__w"), *by).agg(*counters)
    names = [f"__n{i}" for i in range(baseline.bins)]
    n = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return counted.select(
        F.col("__w.start").alias("window_start"),
        F.col("__w.end").alias("window_end"),
        *by,
        n.alias("n"),
        psi_from_counts(baseline, names, limits).alias("psi"),
    )


def drop_replays(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key within the watermark (on a batch frame: one row per key)."""
    return df.dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))
