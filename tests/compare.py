"""Run queries in Spark and their SQL in DuckDB and compare the rows."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, bool) or isinstance(value, int):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return str(value.date())
    if value is None:
        return "null"
    try:
        return round(float(value), 6) + 0.0 if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, df.collect())


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), canonical(columns, cursor.fetchall())
