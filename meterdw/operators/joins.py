"""Joining a fact to a dimension of unknown size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
# a key with more than this share of the fact's rows is split over several tasks
HOT_SHARE = 1 / 1000
# keys made of at most so many rows may be broadcast without a measure
KEY_ROWS = 20_000


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the rows' size in memory: text lengths plus 16 bytes per value and row."""
    text = [F.coalesce(F.octet_length(f.name).cast("long"), F.lit(0))
            for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    row = sum(text, F.lit(16 * (len(df.columns) + 1)).cast("long"))
    return df.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> list[tuple]:
    """(key, pieces) of every key above `share` of all rows: how often it is to be cut.

    Counts are pre-aggregated map-side and only the key column is read; by definition at
    most 1 / share keys come back, whatever the data.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), key).limit(math.ceil(1 / share)).collect()
    threshold = facts.count() * share
    return [(r[key], math.ceil(r["n"] / threshold)) for r in top if r["n"] > threshold]


def split_join(facts: DataFrame, dim: DataFrame, key: str, how: str, spread_by: list[str],
               share: float = HOT_SHARE, dim_spread_by: list[str] | None = None,
               strategy: str | None = None) -> DataFrame:
    """Shuffle join that cuts hot keys into pieces.

    A fact row of a hot key goes to a piece by the hash of `spread_by` (so a retried task
    sends it to the same place); the dimension rows of that key are repeated once per
    piece. A dimension that may itself hold very many rows of one key is cut the same way
    by `dim_spread_by` (inner joins only), with the fact rows repeated. All other keys
    stay whole. Every fact row meets every matching dimension row exactly once.

    Without a `strategy` (a join hint for the dimension) Spark may still broadcast a side
    whose files look small.
    """
    if dim_spread_by and how != "inner":
        raise ValueError("only an inner join can cut the dimension")
    cuts = dict(hot_keys(facts, key, share))
    dim_cuts = dict(hot_keys(dim, key, share)) if dim_spread_by else {}
    if not cuts and not dim_cuts:
        return facts.join(dim.hint(strategy) if strategy else dim, key, how)
    # at most 2 / share rows, so this lookup table may always be broadcast
    schema = T.StructType([T.StructField(key, facts.schema[key].dataType),
                           T.StructField("_cuts", T.IntegerType()), T.StructField("_dim_cuts", T.IntegerType())])
    rows = [(k, cuts.get(k, 1), dim_cuts.get(k, 1)) for k in {*cuts, *dim_cuts}]
    table = F.broadcast(facts.sparkSession.createDataFrame(rows, schema))

    def place(df: DataFrame, own: str, other: str, columns: list[str]) -> DataFrame:
        """One piece of the row's own side by hash, all pieces of the other side."""
        return (df.join(table, key, "left")
                .withColumn(f"_piece{own}", F.expr(f"CAST(pmod(xxhash64({', '.join(columns)}), "
                                                   f"coalesce({own}, 1)) AS INT)"))
                .withColumn(f"_piece{other}", F.expr(f"explode(sequence(0, coalesce({other}, 1) - 1))"))
                .drop("_cuts", "_dim_cuts"))

    left = place(facts, "_cuts", "_dim_cuts", spread_by)
    right = place(dim, "_dim_cuts", "_cuts", dim_spread_by or [key])
    right = right.hint(strategy) if strategy else right
    return left.join(right, [key, "_piece_cuts", "_piece_dim_cuts"], how).drop("_piece_cuts", "_piece_dim_cuts")


def listed(keys: DataFrame, rows: int) -> DataFrame:
    """Keys for a semi or anti join, made of `rows` rows. Many are joined by a shuffle: Spark guesses their size from
    compressed files and the share of their columns, and would collect and broadcast a hundred times as much.
    """
    return keys.hint("merge") if rows > KEY_ROWS else keys


def sized(dim: DataFrame, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """The dimension marked for broadcast if it measures small, else as it is (shuffle join, adaptive)."""
    return F.broadcast(dim) if measured_bytes(dim) <= limit_bytes else dim


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", spread_by: list[str] | None = None,
                dim_spread_by: list[str] | None = None, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """Join facts to a dimension on `key`: broadcast if the dimension measures small, else a split shuffle join, however
    small its files are."""
    if measured_bytes(dim) <= limit_bytes:
        return facts.join(F.broadcast(dim), key, how)
    return split_join(facts, dim, key, how, spread_by or facts.columns, dim_spread_by=dim_spread_by, strategy="merge")
