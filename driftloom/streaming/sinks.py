"""Micro-batch sinks whose effect does not change when a batch is run again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.operators import contract, drift, scoring
from driftloom.session import durable, passing
from driftloom.specs import BUFFER_ROWS, DriftLimits, FieldRule

Sink = Callable[[DataFrame, int], None]


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch as its own partition; a replayed batch replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches written so far, with batch_id as a partition column."""
    return spark.read.parquet(path)


def scoring_sink(
    score: Callable[[DataFrame], DataFrame],
    predictions: str,
    rejects: str,
    rules: Sequence[FieldRule],
    cross: dict[str, Column] | None = None,
    fill: str = "absent",
) -> Sink:
    """Check each batch against the contract, score the valid rows, and set the others aside.

    `score` maps valid records to the prediction columns, for instance training.score of a loaded pipeline.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        checked = contract.check(contract.normalise(batch, rules, fill), rules, cross)
        checked = checked.persist()
        with passing(batch.sparkSession):
            write_batch(score(contract.valid_rows(checked)), predictions, batch_id)
        write_batch(contract.quarantine(checked), rejects, batch_id)
        checked.unpersist()

    return sink


def data_drift_sink(
    reference: DataFrame | drift.Reference, reports: str, features: Sequence[str] | None = None, limits: DriftLimits = DriftLimits()
) -> Sink:
    """A drift report of every arriving batch against the reference, which is fitted once if it is a table."""
    fitted = reference if isinstance(reference, drift.Reference) else drift.fit_reference(reference, features, limits)

    def sink(batch: DataFrame, batch_id: int) -> None:
        with passing(batch.sparkSession):
            if batch.isEmpty():
                return
            write_batch(drift.drift_report(fitted, durable(batch), limits=limits), reports, batch_id)

    return sink


def prediction_drift_sink(
    baseline: DataFrame | drift.Reference,
    score: Callable[[DataFrame], DataFrame],
    buffers: str,
    statuses: str,
    order: Sequence[str],
    n: int = BUFFER_ROWS,
    limits: DriftLimits = DriftLimits(),
) -> Sink:
    """Keep the last n scores and compare them with the baseline after every batch.

    The buffer of a batch is made from the buffer before it, so a batch reads n old rows however long
    the stream has run. Scores carry `probability`, `prediction` and the order columns. A baseline table is
    reduced once (`drift.fit_reference` of `drift.prediction_rows`); its rows are not read again.
    """
    if not isinstance(baseline, drift.Reference):
        baseline = drift.fit_reference(drift.prediction_rows(baseline), limits=limits)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = [*order, "probability", "prediction"]
        with passing(spark):
            rows = score(batch).select(*columns)
            if batch_id > 0:
                rows = rows.unionByName(spark.read.parquet(f"{buffers}/batch_id={batch_id - 1}").select(*columns))
            write_batch(scoring.recent(rows, order, n), buffers, batch_id)
            kept = spark.read.parquet(f"{buffers}/batch_id={batch_id}")
            write_batch(drift.prediction_drift(baseline, kept, limits=limits), statuses, batch_id)

    return sink


def start(stream: DataFrame, sink: Sink, checkpoint: str, available_now: bool = True, mode: str = "append"):
    """Run a sink over a stream; with available_now over what is there, then stop."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode(mode)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_to_end(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append") -> None:
    start(stream, sink, checkpoint, True, mode).awaitTermination()


def table_sink(path: str) -> Sink:
    return lambda batch, batch_id: write_batch(batch, path, batch_id)


def totals(predictions: DataFrame) -> DataFrame:
    """Rows and positives since the start, over a prediction table or (in complete mode) over the stream."""
    return predictions.groupBy().agg(
        F.count(F.lit(1)).alias("total_inferences"), F.sum(F.col("prediction").cast("long")).alias("positives")
    )
