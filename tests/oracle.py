"""Runs a registered query and its SQL twin and compares all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (decimal.Decimal, dt.date)):
        return f"{type(v).__name__}:{v}"
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir) -> str | None:
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf_dir)
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} != {len(want)}; spark {only_got}; sql {only_want}; columns {columns}"
