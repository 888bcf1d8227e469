"""Runs a query's SQL in DuckDB over the tables of a folder, and compares rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        if os.path.exists(path) or "*" in path:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(repr(round(r[k], 9) if isinstance(r[k], float) else r[k]) for k in order) for r in rows)


def same(df, sql, sf_dir):
    result = connect(sf_dir).execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)
