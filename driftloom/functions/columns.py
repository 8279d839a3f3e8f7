"""Scalar helpers. Each returns a native Column expression."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def nan_to_null(c: Column | str) -> Column:
    """Number as double, with NaN read as missing."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def normalise_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes NULL in every floating column (or in the named ones)."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    names = [c for c in floating if cols is None or c in cols]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def strip(c: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def lookup(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Literal mapping; the default takes the place of unmapped and missing values."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.element_at(pairs, col(c))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def bucket_index(c: Column | str, edges: Sequence[float], closed: str = "left") -> Column:
    """How many edges lie at or below the value (closed='left') or strictly below it ('right').

    A balanced tree of comparisons with the very edge doubles: log2(n) tests per row, all in
    generated code. Meant for up to about a hundred edges. NULL stays NULL.
    """
    x = col(c)
    passed = (lambda e: x >= F.lit(float(e))) if closed == "left" else (lambda e: x > F.lit(float(e)))

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(passed(edges[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(x.isNotNull(), tree(0, len(edges)))


def cut(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = False,
    default: str | None = None,
) -> Column:
    """Name the interval a value falls in. Missing and out-of-range values get the default.

    Repeated edges are merged together with the label of the empty interval between them.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    kept_edges, kept_labels = [float(edges[0])], []
    for edge, label in zip(edges[1:], labels):
        if float(edge) > kept_edges[-1]:
            kept_edges.append(float(edge))
            kept_labels.append(label)
    x = col(c)
    low, high = kept_edges[0], kept_edges[-1]
    if right:
        inside = (x >= low if include_lowest else x > low) & (x <= high)
    else:
        inside = (x >= low) & ((x < high) if math.isfinite(high) else F.lit(True))
    which = bucket_index(x, kept_edges[1:-1], closed="right" if right else "left")
    name = F.element_at(F.array(*[F.lit(v) for v in kept_labels]), which + 1) if kept_labels else F.lit(None)
    hit = F.when(x.isNotNull() & inside, name)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def p_value_text(p: Column | str) -> Column:
    """Four decimals, or scientific notation below one in a thousand."""
    x = col(p)
    return F.when(x < 0.001, F.format_string("%.4e", x)).otherwise(F.format_string("%.4f", x))
