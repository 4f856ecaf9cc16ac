"""Comparison of a query with its SQL on the same Parquet tables."""

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(x) for x in value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(r[i]) for i in order) for r in rows
    )


def differences(df, con, sql):
    """Empty if both give the same columns and the same bag of rows, exact to the last digit."""
    result = con.execute(sql)
    expected_columns, expected = _bag([c[0] for c in result.description], result.fetchall())
    columns, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    missing, extra = expected - got, got - expected
    if missing or extra:
        return (
            f"{sum(missing.values())} rows missing, {sum(extra.values())} too many of "
            f"{sum(expected.values())}, e.g. {list(missing)[:3]} / {list(extra)[:3]}"
        )
    return ""
