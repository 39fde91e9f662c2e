"""Run a query on Spark and its SQL on DuckDB and compare schema names, row counts and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_shown(v) for v in value)
    return repr(value)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    names = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    spark_rows = [tuple(row[n] for n in names) for row in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = dict(zip(columns, (str(d[1]) for d in cursor.description)))
    if sorted(columns) != names:
        return f"columns {names} vs {sorted(columns)}"
    places = [columns.index(n) for n in names]
    sql_rows = [tuple(row[p] for p in places) for row in cursor.fetchall()]
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "array<double>": "DOUBLE[]",
    }
    for n in names:
        if same.get(types[n]) != kinds[n]:
            return f"type of {n}: {types[n]} vs {kinds[n]}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} vs {len(sql_rows)}"
    left = sorted(tuple(_shown(v) for v in row) for row in spark_rows)
    right = sorted(tuple(_shown(v) for v in row) for row in sql_rows)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ {names}: {wrong[0][0]} vs {wrong[0][1]}"
    return None
