"""Compare a Spark result with DuckDB's answer to the query's SQL twin."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "bigint": "int",
    "int": "int",
    "integer": "int",
    "smallint": "int",
    "tinyint": "int",
    "hugeint": "hugeint",
    "double": "double",
    "float": "double",
    "string": "string",
    "varchar": "string",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp",
}


def connect(sf: str):
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    return KINDS.get(name, "decimal" if name.startswith("decimal") else name)


def clean(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types and rows are the same."""
    described = {r[0]: kind(r[1]) for r in con.execute("DESCRIBE " + sql).fetchall()}
    ours = {c: kind(t) for c, t in spark_df.dtypes}
    if ours != described:
        return [f"schema: spark {ours} oracle {described}"]
    names = sorted(ours)
    mine = Counter(tuple(clean(r[c]) for c in names) for r in spark_df.collect())
    cols = ", ".join('"' + c + '"' for c in names)
    theirs = Counter(tuple(clean(v) for v in r) for r in con.execute(f"SELECT {cols} FROM ({sql})").fetchall())
    out = [f"only spark {k}" for k in list((mine - theirs).keys())[:3]]
    out += [f"only oracle {k}" for k in list((theirs - mine).keys())[:3]]
    return out
