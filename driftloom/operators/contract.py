"""Row contract: normalise, check, set bad rows aside, and count what was wrong with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null, strip
from driftloom.specs import PASSENGER_RULES, FieldRule

VIOLATIONS = "violations"


def normalise(df: DataFrame, rules: Sequence[FieldRule] = PASSENGER_RULES, fill: str = "absent") -> DataFrame:
    """Add absent columns with their defaults, fill NULLs that have one, and clean enum text.

    fill='null' gives the column default to NULLs as well, for payloads in which an absent field
    and a NULL cannot be told apart.
    """
    out = {}
    for rule in rules:
        if rule.name not in df.columns:
            out[rule.name] = F.lit(rule.default)
            continue
        value = F.col(rule.name)
        if rule.case:
            value = F.lower(strip(value)) if rule.case == "lower" else F.upper(strip(value))
        elif rule.low is not None and dict(df.dtypes)[rule.name] in ("double", "float"):
            value = nan_to_null(value)
        fallback = rule.default if fill == "null" and rule.default is not None else rule.null_default
        out[rule.name] = value if fallback is None else F.coalesce(value, F.lit(fallback))
    return df.withColumns(out)


def rule_breaches(rule: FieldRule) -> list[tuple[str, Column]]:
    """(violation name, condition that is true for a bad row). Missing optional values pass."""
    c = F.col(rule.name)
    found = []
    if rule.required:
        found.append((f"{rule.name}:missing", c.isNull()))
    if rule.allowed:
        found.append((f"{rule.name}:enum", ~c.isin(*rule.allowed)))
    if rule.low is not None or rule.high is not None:
        found.append((f"{rule.name}:range", ~c.between(rule.low, rule.high)))
    if rule.min_length is not None or rule.max_length is not None:
        low, high = rule.min_length or 0, rule.max_length if rule.max_length is not None else 2**31 - 1
        found.append((f"{rule.name}:length", ~F.length(c).between(low, high)))
    return found


def check(
    df: DataFrame, rules: Sequence[FieldRule] = PASSENGER_RULES, cross: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add the array of violated rule names. `cross` maps a rule name to a condition that must not be false."""
    bad = [b for rule in rules for b in rule_breaches(rule)]
    bad += [(name, ~must) for name, must in (cross or {}).items()]
    named = F.array(*[F.when(cond, F.lit(name)) for name, cond in bad])
    return df.withColumn(VIOLATIONS, F.array_compact(named))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def quarantine(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(VIOLATIONS) > 0)


def split(
    df: DataFrame, rules: Sequence[FieldRule] = PASSENGER_RULES, cross: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). One bad row does not reject its neighbours."""
    checked = check(normalise(df, rules), rules, cross)
    return valid_rows(checked), quarantine(checked)


def violation_summary(checked: DataFrame) -> DataFrame:
    """Rows per violated rule: (rule, n)."""
    return checked.select(F.explode(VIOLATIONS).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def refuse_empty(df: DataFrame) -> DataFrame:
    """Guard of the batch entry points: a batch without rows is an error."""
    if df.isEmpty():
        raise ValueError("the batch holds no rows")
    return df
