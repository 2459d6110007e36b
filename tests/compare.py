"""What the tests of registered queries share: the smallest tables in DuckDB, and rows made comparable."""

import math
from pathlib import Path

import duckdb

FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder=FOLDER):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def same(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return repr(round(float(v), 6)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)


def comparable(rows):
    """Dictionaries as sorted tuples of (name, value)."""
    return sorted(tuple((k, same(r[k])) for k in sorted(r)) for r in rows)


def of_duck(connection, sql):
    q = connection.execute(sql)
    names = [d[0] for d in q.description]
    return comparable(dict(zip(names, r, strict=True)) for r in q.fetchall())


def of_spark(df):
    return comparable(r.asDict() for r in df.collect())
