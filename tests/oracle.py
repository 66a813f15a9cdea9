"""Runs a query and its SQL side by side."""

import math
import os

import duckdb

from loamline.tables import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    if type(v).__name__ == "Decimal":
        return str(int(v)) if v == int(v) else str(v)
    return str(v)


def same_rows(df, con, sql):
    columns = sorted(df.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = con.execute(f"SELECT {quoted} FROM ({sql}) q").fetchall()
    got = df.collect()
    a, b = sorted("|".join(plain(r[c]) for c in columns) for r in got), sorted("|".join(map(plain, r)) for r in expected)
    assert a == b, (len(a), len(b), [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2])
