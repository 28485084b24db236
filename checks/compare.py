"""Run a registered query and its SQL twin and compare them as multisets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short description of what differs."""
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    want = rows_of(names, out.fetchall())
    have = rows_of(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if have == want:
        return None
    extra, missing = have - want, want - have
    return (
        f"{sum(have.values())} rows against {sum(want.values())}; "
        f"extra {sum(extra.values())}: {list(extra)[:2]}; missing {sum(missing.values())}: {list(missing)[:2]}"
    )
