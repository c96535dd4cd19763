"""Run a named query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

from kalends.catalog import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, otherwise what differs."""
    df = QUERIES[name](spark, sf_dir)
    got_columns, got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    want_columns, want = rows_by_name([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w and not all(
            a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
            for a, b in zip(g, w)
        ):
            return f"{dict(zip(got_columns, g))} != {dict(zip(want_columns, w))}"
    return None
