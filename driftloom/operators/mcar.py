"""Little's test of values missing completely at random."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from driftloom.functions.columns import numeric_columns
from driftloom.functions.tails import chi2_sf
from driftloom.operators.missing import missing_patterns
from driftloom.operators.patterns import Patterns, added_up, fits_driver, pattern_moments, unpack
from driftloom.session import durable

RIDGE = 1e-6
SIGNIFICANCE = 0.05
SMALL_SHARE = 0.05

RESULT = (
    "is_mcar boolean, chi_square_stat double, degrees_of_freedom long, p_value double, verdict string, "
    "recommended_strategy string, patterns_count long, total_records long, evaluated_columns string, iterations long"
)


@dataclass(frozen=True)
class McarResult:
    is_mcar: bool
    chi_square_stat: float
    degrees_of_freedom: int
    p_value: float
    verdict: str
    recommended_strategy: str
    patterns_count: int
    total_records: int
    evaluated_columns: str
    iterations: int = 0

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame([tuple(vars(self).values())], RESULT)


def _expected(patterns: Patterns, mu: np.ndarray, sigma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over rows of the completed values and of their products, both measured from mu."""
    p = len(mu)
    first, second = np.zeros(p), np.zeros((p, p))
    for n, gone, mean, cov in zip(patterns.n, patterns.missing, patterns.mean, patterns.cov):
        o, m = np.flatnonzero(~gone), np.flatnonzero(gone)
        if len(o) == 0:
            second += n * sigma
            continue
        spread = np.zeros((p, len(o)))
        spread[o, np.arange(len(o))] = 1.0
        rest = np.zeros((p, p))
        if len(m):
            beta = sigma[np.ix_(m, o)] @ np.linalg.pinv(sigma[np.ix_(o, o)])
            spread[m] = beta
            rest[np.ix_(m, m)] = sigma[np.ix_(m, m)] - beta @ sigma[np.ix_(o, m)]
        shift = spread @ (mean[o] - mu[o])
        first += n * shift
        second += n * (np.outer(shift, shift) + spread @ cov[np.ix_(o, o)] @ spread.T + rest)
    return first, second


def _start(patterns: Patterns, mu: np.ndarray) -> np.ndarray:
    """Products of the mean-filled data around mu."""
    centred = np.where(patterns.missing, 0.0, patterns.mean - mu)
    return np.einsum("s,si,sj->ij", patterns.n, centred, centred) + np.einsum("s,sij->ij", patterns.n, patterns.cov)


def _observed_sums(patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    weight = patterns.n[:, None] * ~patterns.missing
    return weight.sum(axis=0), (weight * patterns.mean).sum(axis=0)


def _statistic(patterns: Patterns, mu: np.ndarray, sigma: np.ndarray, include_complete: bool) -> float:
    total, p = 0.0, len(mu)
    for n, gone, mean in zip(patterns.n, patterns.missing, patterns.mean):
        o = np.flatnonzero(~gone)
        if 0 < len(o) < p or (include_complete and len(o) == p):
            d = mean[o] - mu[o]
            total += n * float(d @ np.linalg.pinv(sigma[np.ix_(o, o)]) @ d)
    return total


class _Runner:
    """Applies a sum over patterns: on the driver while the table is small, else one task per partition."""

    def __init__(self, table: DataFrame, p: int):
        self.p = p
        self.table = None
        if fits_driver(table, p):
            frame = table.toPandas()
            order = sorted(range(len(frame)), key=lambda i: tuple(frame["mask"].iloc[i]))
            self.local = unpack(frame.iloc[order].reset_index(drop=True), p)
        else:
            self.table, self.local = table, None

    def sum(self, fn) -> np.ndarray:
        """fn(patterns) -> flat array; the arrays of all patterns are added up."""
        if self.local is not None:
            return fn(self.local)
        p = self.p

        def partial(batches):
            total = None
            for frame in batches:
                if len(frame):
                    part = fn(unpack(frame, p))
                    total = part if total is None else total + part
            if total is not None:
                yield pd.DataFrame({"v": [total.tolist()]})

        return added_up(self.table.mapInPandas(partial, "v array<double>"))


def _fit(run: _Runner, mu: np.ndarray, total: float, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Means, covariances and rounds of expectation-maximisation from the observed means."""
    p = len(mu)
    eye = np.eye(p) * RIDGE
    sigma = run.sum(lambda s: _start(s, mu).ravel()).reshape(p, p) / max(total - 1, 1) + eye
    done = 0
    for done in range(1, max_iter + 1):

        def step(s: Patterns, mu=mu, sigma=sigma) -> np.ndarray:
            first, second = _expected(s, mu, sigma)
            return np.concatenate([first, second.ravel()])

        summed = run.sum(step)
        move = summed[:p] / total
        sigma = summed[p:].reshape(p, p) / total - np.outer(move, move)
        sigma = (sigma + sigma.T) / 2 + eye
        mu = mu + move
        if np.max(np.abs(move)) < tol:
            break
    return mu, sigma, done


def normal_moments(
    df: DataFrame, columns: Sequence[str], max_iter: int = 100, tol: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of a normal law fitted to rows with gaps."""
    p = len(columns)
    run = _Runner(durable(pattern_moments(df, list(columns))), p)
    sums = run.sum(lambda s: np.concatenate([[s.n.sum()], *_observed_sums(s)]))
    counts = sums[1 : 1 + p]
    mu = np.divide(sums[1 + p :], counts, out=np.zeros(p), where=counts > 0)
    return _fit(run, mu, sums[0], max_iter, tol)[:2]


def littles_test(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    max_iter: int = 100,
    tol: float = 1e-4,
    include_complete: bool = False,
) -> McarResult:
    """Chi-square test that missing values are missing completely at random.

    The data are read once, for the moments per pattern; EM runs on those. The complete pattern adds
    nothing to the statistic unless include_complete is set (as in Little, 1988), while it always counts in
    the degrees of freedom.
    """
    numeric = numeric_columns(df)
    cols = [c for c in (columns if columns is not None else numeric) if c in numeric]
    names = ",".join(cols)
    if not cols:
        return McarResult(True, 0.0, 0, 1.0, "no numeric columns to test", "mean", 0, 0, names)
    p = len(cols)
    table = durable(pattern_moments(df, cols))
    run = _Runner(table, p)

    def facts(s: Patterns) -> np.ndarray:
        counts, sums = _observed_sums(s)
        observed = float((~s.missing).sum())
        return np.concatenate([[s.n.sum(), len(s.n), observed, (s.n[:, None] * s.missing).sum()], counts, sums])

    known = run.sum(facts)
    total, patterns_count, observed_columns, holes = known[:4]
    if holes == 0:
        verdict = "no missing values"
        return McarResult(True, 0.0, 0, 1.0, verdict, "passthrough", int(patterns_count), int(total), names)
    counts, sums = known[4 : 4 + p], known[4 + p :]
    mu = np.divide(sums, counts, out=np.zeros(p), where=counts > 0)
    mu, sigma, done = _fit(run, mu, total, max_iter, tol)
    d2 = float(run.sum(lambda s: np.array([_statistic(s, mu, sigma, include_complete)]))[0])
    dof = max(0, int(observed_columns) - p)
    p_value = chi2_sf(d2, dof) if dof > 0 else 1.0
    is_mcar = p_value > SIGNIFICANCE
    if is_mcar:
        strategy = "mean" if holes / (total * p) < SMALL_SHARE else "knn"
        verdict = f"missing completely at random is not rejected (p={p_value:.4f})"
    else:
        strategy = "iterative_mice" if p > 3 else "knn"
        verdict = f"missing completely at random is rejected (p={p_value:.4e})"
    return McarResult(
        is_mcar, round(d2, 4), dof, round(p_value, 6), verdict, strategy, int(patterns_count), int(total), names, done
    )


def patterns_of(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The pattern table that goes with the test."""
    return missing_patterns(df, list(columns) if columns is not None else numeric_columns(df))
