"""Range-partitioned JDBC scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_options(url: str, table: str, column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int | None = None, fetch_size: int = 10_000,
                 **extra: str) -> dict[str, str]:
    """Reader options; `column` with bounds and a partition count makes a parallel scan."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(partitions)}
    return options


def within_bounds(df: DataFrame, column: str, lower: int, upper: int) -> DataFrame:
    """Only rows inside the bounds: the reader's own bounds set the stride and drop nothing."""
    return df.where(F.col(column).between(lower, upper))


def jdbc_scan(spark: SparkSession, url: str, table: str, column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int | None = None, **extra: str) -> DataFrame:
    reader = spark.read.format("jdbc").options(**scan_options(url, table, column, lower, upper, partitions, **extra))
    df = reader.load()
    return df if column is None else within_bounds(df, column, lower, upper)
