"""Runs a registered query and its SQL over the same tables."""

import math
import os

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def text(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(text, v)) + "]"
    return str(v)


def expected(sql: str, sf: str):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{DATA}/{sf}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    r = c.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted("|".join(text(row[i]) for i in order) for row in r.fetchall())


def found(df):
    names = sorted(df.columns)
    return names, sorted("|".join(text(r[n]) for n in names) for r in df.collect())
