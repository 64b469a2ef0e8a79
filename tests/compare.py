"""Comparison of a Spark result with the same query in SQL."""

from pathlib import Path

import duckdb


def database(folder):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    result = connection.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())
