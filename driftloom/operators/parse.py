"""String parsing and row-wise features, all native expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftloom.functions.columns import col, lookup, strip
from driftloom.specs import TITLE_DEFAULT, TITLE_GROUPS


def courtesy_title(c: Column | str) -> Column:
    """Text between the first comma and the next dot; '' where there is none."""
    return strip(F.coalesce(F.regexp_extract(col(c), r",\s*([^.]+)\.", 1), F.lit("")))


def group_rare(c: Column | str, mapping: Mapping = TITLE_GROUPS, default: str = TITLE_DEFAULT) -> Column:
    return lookup(c, mapping, default)


def first_letter(c: Column | str, missing: str = "U") -> Column:
    text = strip(c)
    return F.when(text.isNull() | (text == ""), F.lit(missing)).otherwise(F.upper(F.substring(text, 1, 1)))


def code_prefix(c: Column | str, numeric: str = "NUMERIC") -> Column:
    """First token in upper case when the code has several tokens or is not a plain number."""
    text = strip(F.regexp_replace(col(c), "[./]", ""))
    tokens = F.split(text, r"\s+")
    plain = text.isNull() | (text == "") | ((F.size(tokens) == 1) & text.rlike("^[0-9]+$"))
    return F.when(plain, F.lit(numeric)).otherwise(F.upper(F.get(tokens, F.lit(0))))


def family_size(siblings: Column | str, parents: Column | str) -> Column:
    return col(siblings) + col(parents) + 1


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def rounded_ratio(numerator: Column | str, denominator: Column | str, places: int = 4) -> Column:
    """Quotient rounded half to even."""
    return F.bround(col(numerator) / col(denominator), places)


def interaction(number: Column | str, condition: Column) -> Column:
    return col(number).cast("int") * flag(condition)
