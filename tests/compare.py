"""Rows of Spark and DuckDB in one comparable form."""

import datetime
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def connect(sf_dir):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return database


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"{float(value):.9g}" if value != value.to_integral_value() else str(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_plain(row[i]) for i in order) for row in rows])


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(database, sql):
    result = database.execute(sql)
    return sorted_rows([column[0] for column in result.description], result.fetchall())
