"""The last N scores per segment, kept as stream state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from driftloom.specs import BUFFER_ROWS

# Tasks that cut what is left of one segment before its state sees it.
SLICES = 8
STATE = "orders array<long>, probabilities array<double>, predictions array<int>"


def _trimmed(key: str, order: str, n: int):
    def trim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for frame in batches:
            joined = frame if kept is None else pd.concat([kept, frame])
            kept = joined.sort_values(order).groupby(key, sort=False).tail(n)
        if kept is not None:
            yield kept

    return trim


def last_n_by_segment(stream: DataFrame, segment: str, order: str, n: int = BUFFER_ROWS) -> DataFrame:
    """(segment, buffer_size, average_probability, positive_rate), updated per micro-batch.

    `order` is a growing number (an arrival id). Each task first cuts its rows to the last n per segment: no other row can
    be among the last n. What is left of a segment meets in SLICES tasks, which cut again, so its state
    gets at most SLICES * n rows, however many tasks the segment came from.
    """
    rows = stream.select(segment, order, "probability", "prediction")
    rows = rows.mapInPandas(_trimmed(segment, order, n), rows.schema)
    rows = rows.repartition(F.col(segment), F.pmod(F.xxhash64(order), F.lit(SLICES)))
    rows = rows.mapInPandas(_trimmed(segment, order, n), rows.schema)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        orders, probabilities, predictions = (list(x) for x in state.get) if state.exists else ([], [], [])
        for frame in frames:
            orders += [int(v) for v in frame[order]]
            probabilities += [float(v) for v in frame["probability"]]
            predictions += [int(v) for v in frame["prediction"]]
        newest = sorted(range(len(orders)), key=orders.__getitem__)[-n:]
        orders = [orders[i] for i in newest]
        probabilities = [probabilities[i] for i in newest]
        predictions = [predictions[i] for i in newest]
        state.update((orders, probabilities, predictions))
        size = len(newest)
        yield pd.DataFrame(
            {
                segment: [key[0]],
                "buffer_size": [size],
                "average_probability": [sum(probabilities) / size],
                "positive_rate": [sum(predictions) / size],
            }
        )

    out = f"`{segment}` {dict(stream.dtypes)[segment]}, buffer_size long, average_probability double, positive_rate double"
    return rows.groupBy(segment).applyInPandasWithState(update, out, STATE, "update", GroupStateTimeout.NoTimeout)
