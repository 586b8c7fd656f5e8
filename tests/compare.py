"""Exact comparison of a Spark result with DuckDB over the same parquet tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    """Column names in order, and rows as sorted tuples with columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def spark_types(result):
    return {name: SQL_TYPES[kind] for name, kind in result.dtypes}


def duckdb_types(con, sql):
    return {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(result):
    return canonical(result.columns, [tuple(row) for row in result.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())
