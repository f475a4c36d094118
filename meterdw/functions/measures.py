"""Exact averages and calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def avg_text(total: str, count: str, to_type: str) -> str:
    """SQL text of total / count, rounded half-up once to the declared scale; NULL when count is 0.

    AVG on a decimal rounds to six digits first; dividing the exact sum keeps enough
    digits that only the final cast decides.
    """
    return f"CAST(CAST({total} AS DECIMAL(22,3)) / CAST(NULLIF({count}, 0) AS DECIMAL(19,0)) AS {to_type})"


def exact_avg(total: str, count: str, to_type: str) -> Column:
    return F.expr(avg_text(total, count, to_type))


def column_avg(column: str, to_type: str) -> Column:
    """exact_avg of a column inside an aggregation."""
    return exact_avg(f"SUM({column})", f"COUNT({column})", to_type)


def stat_date(ts: str) -> Column:
    return F.to_date(ts)


def stat_hour(ts: str) -> Column:
    return F.hour(ts)


def as_column(value) -> Column:
    """A time argument: a column (e.g. a scalar subquery) or a Python timestamp literal."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def before(as_of: dt.datetime, age: str) -> Column:
    """The moment `age` (e.g. '1 HOUR') before a literal time."""
    return as_column(as_of) - F.expr(f"INTERVAL {age}")


def newest(df: DataFrame, ts: str, shift: str = "") -> Column:
    """Scalar subquery: the newest time of a table, shifted (e.g. '- INTERVAL 1 HOUR').

    The shift is part of the subquery, so a comparison with the result stays a plain
    column-to-value filter, the form file and partition pruning understand.
    """
    return df.agg(F.expr(f"MAX({ts}) {shift} AS newest")).scalar()
