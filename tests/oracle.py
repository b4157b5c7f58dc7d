"""Runs a bound query and its SQL on the same tables and compares the rows."""

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def types_of(df):
    return {f.name: f.dataType.simpleString() for f in df.schema}


DUCK_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(df, con, sql):
    """None when equal, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    duck_types = {d[0]: DUCK_TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    duck = normal(columns, result.fetchall())
    spark = normal(df.columns, [tuple(r) for r in df.collect()])
    if spark[0] != duck[0]:
        return f"columns {spark[0]} and {duck[0]}"
    if len(spark[1]) != len(duck[1]):
        return f"{len(spark[1])} rows and {len(duck[1])}"
    for mine, theirs in zip(spark[1], duck[1]):
        if mine != theirs:
            return f"{mine} and {theirs}"
    mine = types_of(df)
    wrong = {c: (mine[c], duck_types[c]) for c in mine if mine[c] != duck_types[c]}
    return f"types {wrong}" if wrong else None
