"""Compare a registered query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def cell(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        value = float(value)
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    expected = rows_of(expected_columns, result.fetchall())
    actual = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if actual == expected:
        return None
    missing, extra = sorted(set(expected) - set(actual)), sorted(set(actual) - set(expected))
    return f"{len(actual)} rows, expected {len(expected)}; missing {missing[:3]}; extra {extra[:3]}"
