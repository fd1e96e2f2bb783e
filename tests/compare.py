"""Compare a Spark result with the result of its SQL on another engine."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if the results agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = _rows(names, found.fetchall())
    actual = _rows(df.columns, df.collect())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows vs {len(expected)}")
    if actual != expected:
        gone = [r for r in expected if r not in actual][:3]
        extra = [r for r in actual if r not in expected][:3]
        problems.append(f"only in Spark {extra}; only in SQL {gone}")
    return problems
