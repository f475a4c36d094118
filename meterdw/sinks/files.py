"""File tables: append logs, keyed upsert logs, staged full refreshes.

Parquet has no MERGE. A keyed table is therefore a log of batches plus a view that keeps
the newest row per key. A batch always lands in its own folder and replaces it when
replayed, so a retried or restarted micro-batch changes nothing.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw.operators.quality import duplicates
from meterdw.operators.serving import latest


def append_rows(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


# --- keyed upsert log -----------------------------------------------------------------------

def upsert_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Idempotent write of one batch: replaying a batch id replaces its folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def read_latest(spark: SparkSession, path: str, keys: list[str], newest: list[Column] | None = None) -> DataFrame:
    """One row per key: the newest by the given ordering, then the row of the latest batch.

    Without an ordering the last arrival wins, whatever its event time.
    """
    order = [*(newest or []), F.desc("batch_id")]
    return latest(read_batches(spark, path), keys, order).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, keys: list[str], newest: list[Column] | None = None) -> None:
    """Writes the current rows as one batch of a new log, numbered after the last one it replaces."""
    last = read_batches(spark, path).agg(F.max("batch_id")).first()[0]
    upsert_batch(read_latest(spark, path, keys, newest), last, target)


# --- staged full refresh --------------------------------------------------------------------

class DuplicateKeys(ValueError):
    """A staged table breaks a uniqueness rule and was not published."""


def full_refresh(df: DataFrame, path: str, unique: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> None:
    """Replaces the table at `path` as a whole, or not at all.

    Rows are staged under a new run folder; readers switch when the run is recorded as
    published, which is one small committed write. A failure or a duplicate key before
    that leaves the previous rows in place. Partition large tables by date: Parquet
    statistics on zone-less timestamps are not used for skipping, partitions are.
    """
    run = time.time_ns()
    staged = f"{path}/rows/run={run}"
    # one task per date (or a few, for large ones) instead of a file of every date from every task
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(staged)
    spark = df.sparkSession
    if unique and not duplicates(spark.read.parquet(staged), list(unique)).isEmpty():
        raise DuplicateKeys(f"duplicate {unique} in {staged}")
    spark.range(1).select(F.lit(run).alias("run")).write.mode("append").parquet(f"{path}/published")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    run = spark.read.parquet(f"{path}/published").agg(F.max("run")).first()[0]
    return spark.read.parquet(f"{path}/rows/run={run}")
