"""Runs a registered query and its SQL check, and compares values."""

import datetime
import decimal
import math

import duckdb
import numpy as np

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal in a result: cast it")
    if isinstance(value, (datetime.datetime, datetime.date)):
        raise TypeError("time in a result: format it")
    if isinstance(value, (list, tuple, dict)):
        raise TypeError("nested value in a result: flatten it")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-12 * max(abs(a), abs(b))
    return a == b and type(a) is type(b)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    found = con.execute(sql)
    want_names, want = rows_of([d[0] for d in found.description], found.fetchall())
    got_names, got = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows on either side"
    for left, right in zip(got, want):
        if not all(close(a, b) for a, b in zip(left, right)):
            return f"{got_names}\n  {str(left)[:600]}\n  {str(right)[:600]}"
    return None
