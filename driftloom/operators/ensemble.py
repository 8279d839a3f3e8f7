"""Blending of given scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftloom.functions.columns import col


def soft_vote(scores: Sequence[Column | str], weights: Sequence[float] | None = None) -> Column:
    """Weighted mean of probabilities, as one expression on the row."""
    weights = list(weights or [1.0] * len(scores))
    if len(weights) != len(scores):
        raise ValueError("one weight per score is needed")
    total = sum(weights)
    terms = [col(s) * float(w) for s, w in zip(scores, weights)]
    return sum(terms[1:], terms[0]) / F.lit(float(total))
