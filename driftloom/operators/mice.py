"""Chained Bayesian ridge regressions for missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftloom.functions.columns import nan_to_null
from driftloom.operators.patterns import Patterns, added_up, fits_driver, pattern_moments, unpack
from driftloom.session import durable


@dataclass(frozen=True)
class Step:
    """x[target] = intercept + coef . x, with coef[target] = 0."""

    target: int
    intercept: float
    coef: tuple[float, ...]


@dataclass(frozen=True)
class Chain:
    columns: tuple[str, ...]
    start: tuple[float, ...]
    steps: tuple[Step, ...]
    rounds: int


def bayesian_ridge(gram: np.ndarray, max_iter: int = 300, tol: float = 1e-3) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from the moments of (1, x..., y), by evidence maximisation (MacKay, 1992).

    Gamma priors of 1e-6 on both precisions, as is usual for this model.
    """
    tiny = 1e-6
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    xx, xy, yy = centred[:-1, :-1], centred[:-1, -1], max(centred[-1, -1], 0.0)
    values, vectors = np.linalg.eigh((xx + xx.T) / 2)
    values = np.clip(values, 0.0, None)
    turned = vectors.T @ xy
    alpha, lam = 1.0 / (yy / n + np.finfo(float).eps), 1.0

    def solve() -> tuple[np.ndarray, float]:
        w = turned / (values + lam / alpha)
        sse = yy - 2 * float(w @ turned) + float(values @ (w * w))
        return w, max(sse, 0.0)

    last = None
    for _ in range(max_iter):
        w, sse = solve()
        gamma = float(np.sum(alpha * values / (lam + alpha * values)))
        lam = (gamma + 2 * tiny) / (float(w @ w) + 2 * tiny)
        alpha = (n - gamma + 2 * tiny) / (sse + 2 * tiny)
        coef = vectors @ w
        if last is not None and np.sum(np.abs(last - coef)) < tol:
            break
        last = coef
    coef = vectors @ solve()[0]
    return coef, float(mean[-1] - coef @ mean[:-1])


def replay(values: np.ndarray, start: np.ndarray, steps: Sequence[Step]) -> np.ndarray:
    """Fill the NaNs of a block of rows: column means first, then the chain."""
    gone = np.isnan(values)
    x = np.where(gone, start, values)
    for s in steps:
        rows = gone[:, s.target]
        if rows.any():
            x[rows, s.target] = x[rows] @ np.array(s.coef) + s.intercept
    return x


class _Moments:
    """Moments of the currently completed data over the rows in which a column is observed.

    While a column is missing it is an affine function of the observed ones, so the moments follow from
    those per pattern, without another pass over the rows.
    """

    def __init__(self, patterns: Patterns, centre: np.ndarray):
        s, p = patterns.missing.shape
        self.patterns = patterns
        mean = np.where(patterns.missing, 0.0, patterns.mean - centre)
        raw = np.zeros((s, p + 1, p + 1))
        raw[:, 0, 0] = patterns.n
        raw[:, 0, 1:] = raw[:, 1:, 0] = patterns.n[:, None] * mean
        raw[:, 1:, 1:] = patterns.n[:, None, None] * (patterns.cov + mean[:, :, None] * mean[:, None, :])
        self.raw = raw
        self.maps = np.broadcast_to(np.eye(p + 1), (s, p + 1, p + 1)).copy()
        for j in range(p):
            self.maps[patterns.missing[:, j], j + 1] = 0.0

    def gram(self, j: int) -> np.ndarray:
        seen = ~self.patterns.missing[:, j]
        a = self.maps[seen]
        return np.einsum("sik,skl,sjl->ij", a, self.raw[seen], a)

    def update(self, step: Step) -> None:
        gone = self.patterns.missing[:, step.target]
        if gone.any():
            row = np.einsum("i,sik->sk", np.array(step.coef), self.maps[gone][:, 1:])
            row[:, 0] += step.intercept
            self.maps[gone, step.target + 1] = row


def _row_gram(rows: DataFrame, start: np.ndarray, steps: Sequence[Step], j: int) -> np.ndarray:
    """The same moments from the rows themselves, for data with too many patterns: one pass, one row per task."""
    steps, centre = list(steps), start

    def partial(batches):
        total = None
        for frame in batches:
            values = frame.to_numpy(dtype=float)
            seen = ~np.isnan(values[:, j])
            if seen.any():
                x = replay(values[seen], centre, steps) - centre
                z = np.column_stack([np.ones(len(x)), x])
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pd.DataFrame({"v": [total.ravel().tolist()]})

    return added_up(rows.mapInPandas(partial, "v array<double>")).reshape(len(start) + 1, -1)


def _largest_change(rows: DataFrame, start: np.ndarray, steps: Sequence[Step], per_round: int) -> float:
    """Largest row sum of absolute changes in the last round."""
    before, after = list(steps[:-per_round]), list(steps)

    def partial(batches):
        top = 0.0
        for frame in batches:
            values = frame.to_numpy(dtype=float)
            values = values[np.isnan(values).any(axis=1)]
            if len(values):
                moved = np.abs(replay(values, start, after) - replay(values, start, before))
                top = max(top, float(moved.sum(axis=1).max()))
        yield pd.DataFrame({"v": [top]})

    return rows.mapInPandas(partial, "v double").agg(F.max("v")).first()[0] or 0.0


def fit_chain(df: DataFrame, cols: Sequence[str], max_rounds: int = 10, tol: float = 1e-3) -> Chain:
    """Fit the chain: columns in order of ascending missing count, at most max_rounds rounds.

    One pass gathers the moments per pattern. A round then costs the driver a few small matrices, and the
    data one map-only pass for the stopping rule (change below tol times the largest observed value).
    """
    cols = list(cols)
    p = len(cols)
    rows = df.select(*[nan_to_null(c).alias(c) for c in cols])
    facts = rows.agg(
        *[F.count(c).alias(f"__n{i}") for i, c in enumerate(cols)],
        *[F.avg(c).alias(f"__m{i}") for i, c in enumerate(cols)],
        F.greatest(*[F.max(F.abs(c)) for c in cols], F.lit(0.0)).alias("__top"),
    ).first()
    observed = np.array([facts[f"__n{i}"] for i in range(p)])
    if (observed == 0).any():
        raise ValueError(f"no value at all in {[c for c, n in zip(cols, observed) if n == 0]}")
    start = np.array([facts[f"__m{i}"] for i in range(p)])
    table = durable(pattern_moments(rows, cols))
    moments = None
    if fits_driver(table, p):
        moments = _Moments(unpack(table.toPandas(), p), start)
    order = [int(j) for j in np.argsort(-observed, kind="stable")]
    steps: list[Step] = []
    done = 0
    for done in range(1, max_rounds + 1):
        for j in order:
            gram = moments.gram(j) if moments is not None else _row_gram(rows, start, steps, j)
            others = [i for i in range(p) if i != j]
            pick = [0, *[i + 1 for i in others], j + 1]
            w, b = bayesian_ridge(gram[np.ix_(pick, pick)])
            coef = np.zeros(p)
            coef[others] = w
            centred = Step(j, b, tuple(coef))
            if moments is not None:
                moments.update(centred)
            steps.append(Step(j, float(b + start[j] - coef @ start), tuple(coef)))
        if _largest_change(rows, start, steps, p) < tol * facts["__top"]:
            break
    return Chain(tuple(cols), tuple(start), tuple(steps), done)


def apply_chain(df: DataFrame, chain: Chain) -> DataFrame:
    """Fill missing values row by row with the fitted chain, in Arrow batches and without a shuffle."""
    cols = list(chain.columns)
    rest = [c for c in df.columns if c not in cols]
    schema = T.StructType(
        [T.StructField(f.name, T.DoubleType()) if f.name in cols else f for f in df.schema.fields]
    )
    start, steps, names = np.array(chain.start), list(chain.steps), list(df.columns)

    def fill(batches):
        for frame in batches:
            done = replay(frame[cols].to_numpy(dtype=float), start, steps)
            for i, c in enumerate(cols):
                frame[c] = done[:, i]
            yield frame[names]

    clean = df.select(*[nan_to_null(c).alias(c) if c not in rest else F.col(c) for c in df.columns])
    return clean.mapInPandas(fill, schema)
