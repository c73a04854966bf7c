"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def spark_types(df) -> list[tuple[str, str]]:
    return sorted((name, SQL_TYPES[kind]) for name, kind in df.dtypes)


def duckdb_types(connection, sql: str) -> list[tuple[str, str]]:
    return sorted(row[:2] for row in connection.execute(f"DESCRIBE {sql}").fetchall())


def spark_rows(df) -> list[tuple]:
    return rows_of(df.columns, df.collect())


def duckdb_rows(connection, sql: str) -> list[tuple]:
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
