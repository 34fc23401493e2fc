"""Result comparison helpers: order-insensitive, column-name aligned."""

from __future__ import annotations

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, dt.timedelta):
        return v.total_seconds()
    return v


def spark_rows(df, cols=None):
    cols = sorted(cols or df.columns)
    return sorted((tuple(str(norm(r[c])) for c in cols) for r in df.collect()))


def duck_rows(con, sql, cols=None):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(cols or names)
    idx = [names.index(c) for c in cols]
    return sorted(tuple(str(norm(r[i])) for i in idx) for r in cur.fetchall())


def assert_same(df, con, sql):
    s_cols = sorted(df.columns)
    cur = con.execute(f"SELECT * FROM ({sql}) LIMIT 0")
    d_cols = sorted(d[0] for d in cur.description)
    assert s_cols == d_cols, (s_cols, d_cols)
    s, d = spark_rows(df), duck_rows(con, sql)
    assert len(s) == len(d), (len(s), len(d))
    if s != d:
        only_s = sorted(set(s) - set(d))[:3]
        only_d = sorted(set(d) - set(s))[:3]
        raise AssertionError(f"rows differ; only spark {only_s}; only duckdb {only_d}")
