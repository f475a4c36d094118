"""Compares a query's result with its SQL statement run in DuckDB: names, types, rows, values."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

# Spark type -> DuckDB type, where the names differ
TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
              "boolean": "BOOLEAN", "double": "DOUBLE"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() if value else Decimal(0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    rel = con.sql(sql)
    out = []
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if set(spark_types) != set(duck_types):
        return [f"columns differ: {sorted(set(spark_types) ^ set(duck_types))}"]
    out += [f"type of {c}: {spark_types[c]} / {duck_types[c]}" for c in spark_types if spark_types[c] != duck_types[c]]
    mine, theirs = _rows(df.columns, df.collect()), _rows(rel.columns, rel.fetchall())
    if mine != theirs:
        out.append(f"rows {sum(mine.values())} / {sum(theirs.values())}; "
                   f"only here {list((mine - theirs).items())[:2]}; only SQL {list((theirs - mine).items())[:2]}")
    return out
