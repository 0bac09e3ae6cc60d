"""Compare a query with its SQL, as rows without order."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return ("f", round(v, 9) if v == v else "nan")
    if isinstance(v, decimal.Decimal):
        return ("f", round(float(v), 9))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, datetime.datetime):
        return ("d", v.replace(tzinfo=None).isoformat())
    if isinstance(v, datetime.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(plain(x) for x in v))
    return ("n", "") if v is None else ("s", str(v))


def kind(name: str) -> str:
    return "d" if name.startswith(("timestamp", "TIMESTAMP")) else name


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in order) for r in want_rows), key=repr)
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; first {got[:2]} and {want[:2]}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"{order}: {g} and {w}"
    return ""


__all__ = ["differences", "duck"]
