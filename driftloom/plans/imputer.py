"""Imputation as an estimator: diagnose, fit, apply."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import numeric_columns
from driftloom.operators import knn, mcar, mice, missing
from driftloom.plans.persist import ComposedModel

SIMPLE = ("mean", "median", "most_frequent", "constant")


class MissingImputerModel(ComposedModel):
    """state: strategy, columns, id_col, k, values, chain, flagged, on_new, diagnosis. tables: of knn.fit (for knn)."""

    @property
    def diagnosis(self) -> dict | None:
        return self.state.get("diagnosis")

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        cols = s["columns"]
        if s["flagged"] is not None:
            df = missing.indicators(df, s["flagged"], cols, s["on_new"])
        if s["strategy"] in SIMPLE:
            return missing.fill(df, s["values"])
        if s["strategy"] == "knn":
            return knn.fill(df, self.tables, cols, s["id_col"], s["k"], s["targets"])
        if s["strategy"] == "iterative_mice":
            c = s["chain"]
            steps = tuple(mice.Step(t, b, tuple(w)) for t, b, w in c["steps"])
            return mice.apply_chain(df, mice.Chain(tuple(c["columns"]), tuple(c["start"]), steps, c["rounds"]))
        return df


class MissingImputer(Estimator):
    """strategy: mean, median, most_frequent, constant, knn, iterative_mice, or auto (what the MCAR test recommends)."""

    def __init__(
        self,
        columns: Sequence[str],
        strategy: str = "knn",
        id_col: str | None = None,
        k: int = 5,
        add_indicator: bool = True,
        on_new: str = "error",
        diagnose: bool = True,
        fill_value=None,
        targets: Sequence[str] | None = None,
    ):
        super().__init__()
        self.columns, self.strategy, self.id_col, self.k = list(columns), strategy, id_col, k
        self.add_indicator, self.on_new, self.diagnose = add_indicator, on_new, diagnose
        self.fill_value, self.targets = fill_value, list(targets) if targets else None

    def _fit(self, df: DataFrame) -> MissingImputerModel:
        cols = self.columns
        numeric = [c for c in cols if c in numeric_columns(df)]
        diagnosis = None
        if numeric and (self.diagnose or self.strategy == "auto"):
            diagnosis = dict(vars(mcar.littles_test(df, numeric)))
        strategy = self.strategy
        if strategy == "auto":
            strategy = diagnosis["recommended_strategy"] if diagnosis else "most_frequent"
        state = {
            "strategy": strategy,
            "columns": cols,
            "id_col": self.id_col,
            "k": self.k,
            "targets": self.targets,
            "on_new": self.on_new,
            "flagged": missing.columns_with_missing(df, cols) if self.add_indicator else None,
            "diagnosis": diagnosis,
        }
        tables = {}
        if strategy in SIMPLE:
            state["values"] = missing.fill_values(df, cols, strategy, self.fill_value)
        elif strategy == "knn":
            if not self.id_col:
                raise ValueError("knn needs id_col, which orders donors at the same distance")
            tables = knn.fit(df, cols, self.id_col, self.k, self.targets)
        elif strategy == "iterative_mice":
            chain = mice.fit_chain(df, cols)
            steps = [[s.target, s.intercept, list(s.coef)] for s in chain.steps]
            state["chain"] = {"columns": cols, "start": list(chain.start), "steps": steps, "rounds": chain.rounds}
        elif strategy != "passthrough":
            raise ValueError(f"unknown strategy {strategy}")
        return MissingImputerModel(json.loads(json.dumps(state)), tables)


def unfilled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns that still have missing values, for instance because they held no value at fit."""
    return missing.missing_percent(df, cols).where(F.col("missing") > 0)
