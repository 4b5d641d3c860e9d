"""Rows of a query and of its SQL, made comparable."""

import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(row[n]) for n in names) for row in df.collect())


def sql_rows(sql, sf_dir=SF_DIR, **views):
    con = duckdb.connect()
    for name in TABLES:
        if name not in views and os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    for name, frame in views.items():
        con.register(name, frame)
    result = con.sql(sql)
    at = [result.columns.index(n) for n in sorted(result.columns)]
    return sorted(result.columns), sorted(tuple(plain(row[i]) for i in at) for row in result.fetchall())
