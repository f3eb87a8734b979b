"""Compare a registered query with its SQL twin on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _value(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, dt.datetime) and v.tzinfo:
        v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def difference(frame, connection, sql: str) -> str | None:
    """None if both hold the same rows, else what differs."""
    result = connection.sql(sql)
    want_columns = result.columns
    if sorted(frame.columns) != sorted(want_columns):
        return f"columns {sorted(frame.columns)} != {sorted(want_columns)}"
    order = sorted(frame.columns)
    got = Counter(tuple(_value(r[c]) for c in order) for r in frame.collect())
    at = [want_columns.index(c) for c in order]
    want = Counter(tuple(_value(r[i]) for i in at) for r in result.fetchall())
    if got == want:
        return None
    only_got, only_want = got - want, want - got
    return (
        f"{order}: {sum(got.values())} rows != {sum(want.values())}; "
        f"extra {list(only_got)[:3]}, missing {list(only_want)[:3]}"
    )
