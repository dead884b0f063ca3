"""Spark result against DuckDB result: names, value types and rows."""

import math
from datetime import datetime
from decimal import Decimal

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf):
    con = duckdb.connect()
    for name in NAMES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _key(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def differences(df, con, sql, show=3):
    """Empty list if equal."""
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, [str(kind) for kind in relation.types]))
    mine = dict(df.dtypes)
    if set(mine) != set(theirs):
        return [f"columns {sorted(mine)} != {sorted(theirs)}"]
    names = sorted(mine)
    problems = [f"type of {n}: {mine[n]} / {theirs[n]}" for n in names if KINDS.get(mine[n]) != theirs[n]]
    left = sorted((tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    order = ", ".join(f'"{n}"' for n in names)
    right = sorted((tuple(_plain(v) for v in row) for row in con.sql(f"SELECT {order} FROM ({sql})").fetchall()), key=_key)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ")
        for a, b in wrong[:show]:
            problems.append(str([(n, x, y) for n, x, y in zip(names, a, b) if x != y][:6]))
    return problems


__all__ = ["connect", "differences", "Decimal", "datetime"]
