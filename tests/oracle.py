"""Compare registered queries with their SQL twins in DuckDB, as multisets of rows."""

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if actual != expected:
        missing, extra = expected - actual, actual - expected
        return (
            f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
            f"missing {list(missing)[:2]}, extra {list(extra)[:2]}"
        )
    return None
