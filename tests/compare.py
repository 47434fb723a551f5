"""Run a query on Spark and its SQL on DuckDB over the same files and compare all rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES.split():
        path = f"{folder}/{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in rows)


def assert_same(df, con, sql):
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert found == wanted
