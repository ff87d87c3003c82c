"""Compare a registered query with its SQL in DuckDB, regardless of row and column order."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def _cell(value):
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return repr(value) if isinstance(value, float) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_side(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_side(sql: str, sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    return sorted(names), _rows(names, found.fetchall()), types


# Spark type -> the name DuckDB uses for the same type.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "date": "DATE", "array<bigint>": "BIGINT[]", "array<double>": "DOUBLE[]",
         "array<string>": "VARCHAR[]"}


def difference(df, sql: str, sf_dir: str) -> str | None:
    """A short description of the first difference, or None."""
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    names, rows = spark_side(df)
    duck_names, duck_rows, duck_types = duck_side(sql, sf_dir)
    if names != duck_names:
        return f"columns {names} vs {duck_names}"
    off = {n: (spark_types[n], duck_types[n]) for n in names if spark_types[n] != duck_types[n]}
    if off:
        return f"types {off}"
    if len(rows) != len(duck_rows):
        return f"rows {len(rows)} vs {len(duck_rows)}"
    wrong = [(a, b) for a, b in zip(rows, duck_rows) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
