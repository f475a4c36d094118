"""Checks: uniqueness, references, reconciliation, row flow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterdw.operators.joins import lookup_join


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, row_id: str = "id") -> DataFrame:
    """Child rows whose foreign key is set and names no parent."""
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return lookup_join(child.where(F.col(fk).isNotNull()), known, fk, "left_anti", spread_by=[row_id])


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str], names=("raw", "dws")) -> DataFrame:
    """Full outer comparison of two summaries; NULL equals NULL."""
    left, right = names
    x = a.select(*keys, F.lit(True).alias("_a"), *[F.col(m).alias(f"{left}_{m}") for m in measures])
    y = b.select(*keys, F.lit(True).alias("_b"), *[F.col(m).alias(f"{right}_{m}") for m in measures])
    same = reduce(Column.__and__, [F.col(f"{left}_{m}").eqNullSafe(F.col(f"{right}_{m}")) for m in measures])
    verdict = (F.when(F.col("_b").isNull(), f"{left}_only").when(F.col("_a").isNull(), f"{right}_only")
               .when(same, "match").otherwise("differs"))
    return x.join(y, keys, "full").withColumn("verdict", verdict).drop("_a", "_b")


RANGES = 16


def range_digests(df: DataFrame, keys: list[str], measures: list[str], day: str, ranges: int = RANGES) -> DataFrame:
    """Per day and range of the keys' hash: rows, and a sum of row hashes that no order of rows changes.

    Every task adds up its own rows first, so a day of any size sends one row a range and task. The rows of a table and
    those of its copy are hashed alike if keys and measures have the same types.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("part")
    row = F.xxhash64(*keys, *measures).cast("decimal(38,0)")
    return df.groupBy(F.col(day).alias("day"), part).agg(F.count("*").alias("n"), F.sum(row).alias("digest"))


def differing_ranges(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str], day: str,
                     ranges: int = RANGES) -> DataFrame:
    """The (day, part) in which two tables do not hold the same rows."""
    both = range_digests(a, keys, measures, day, ranges).union(range_digests(b, keys, measures, day, ranges))
    # each side has one row a range: what both hold alike comes twice
    alone = both.groupBy("day", "part", "n", "digest").agg(F.count("*").alias("sides")).where(F.col("sides") == 1)
    return alone.select("day", "part").distinct()


def reconcile_ranges(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str], day: str,
                     names=("raw", "dws"), ranges: int = RANGES) -> DataFrame:
    """The rows of `reconcile` that do not match. Digests are compared first; only ranges that differ are joined by row.

    `day` is one of the keys. Two ranges of equal count and digest are taken as equal: sums of 64-bit hashes agree by
    chance once in about 2^64 comparisons. A list of days and ranges is at most days x `ranges` long.
    """
    found = differing_ranges(a, b, keys, measures, day, ranges)
    part = F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")

    def concerned(df: DataFrame) -> DataFrame:
        rows = df.select(*keys, *measures).withColumn("_part", part)
        listed = found.select(F.col("day").alias("_day"), F.col("part").alias("_wanted"))
        return rows.join(listed, F.col(day).eqNullSafe(F.col("_day")) & (F.col("_part") == F.col("_wanted")), "left_semi")

    return reconcile(concerned(a), concerned(b), keys, measures, names).where(F.col("verdict") != "match")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of labelled row counts."""
    parts = [df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def layer_flow(layers: dict[str, tuple[DataFrame, str]], since) -> DataFrame:
    """Per layer: rows, rows at or after `since`, and the newest time (how far the layer lags)."""
    parts = [df.agg(F.count("*").alias("row_count"), F.count_if(F.col(ts) >= since).alias("fresh_rows"),
                    F.max(ts).alias("last_time"))
             .select(F.lit(name).alias("layer"), "row_count", "fresh_rows", "last_time")
             for name, (df, ts) in layers.items()]
    return reduce(DataFrame.unionByName, parts)
