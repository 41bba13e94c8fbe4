"""Compare a Spark result with the SQL result of DuckDB, as sorted rows."""

from __future__ import annotations

import datetime as dt

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _sorted(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in places) for row in rows]
    return [names[i] for i in places], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(db, sql):
    cursor = db.execute(sql)
    return _sorted([column[0] for column in cursor.description], cursor.fetchall())
