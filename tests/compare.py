"""Row-for-row comparison of a registered query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, (Decimal, dt.date)):
        raise TypeError(f"results should hold plain types, not {type(value)}")
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, int, list, list]:
    """Row counts of both sides and samples of what only one of them has."""
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    want = rows_of(columns, answer.fetchall())
    assert sorted(df.columns) == sorted(columns), set(df.columns) ^ set(columns)
    got = rows_of(df.columns, df.collect())
    return (
        sum(got.values()),
        sum(want.values()),
        list((got - want).items())[:3],
        list((want - got).items())[:3],
    )
