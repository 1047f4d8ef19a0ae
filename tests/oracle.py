"""Compare a Spark result with a DuckDB one as multisets of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when both give the same rows, else what differs."""
    result = con.execute(sql)
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; only in Spark: {list(extra.items())[:3]}; "
            f"only in DuckDB: {list(missing.items())[:3]}"
        )
    return None
