"""Shards that all have the mixture of the whole: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; (rank - 1/2) / (rows of the source) spreads every
source evenly over the unit interval. Sorted by that fraction, any cut into equal runs has each source in proportion.

Neither ranking puts a source, or the whole, into one task: hash bits cut a source into buckets that are ranked
apart and set off by the counts of the buckets before them, and fractions are cut into buckets the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterdw.llm.common import staged

SEED = 17
# 4096 hash buckets in each source and 4096 buckets of fractions: 25 million rows in a bucket at 10^11 rows
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
HASH_DIGITS = 15


def interleave(rows: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: int = SEED,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns key, source, `carry`, shard (0 to shards - 1) and slot (0, 1, ... in the shard), counts at most one apart.

    Null sources are a source of their own; a null key is shuffled as the empty text. Rows with equal keys are ordered
    by what they carry, and rows alike in that too are interchangeable. An empty table gives no rows; with fewer rows
    than shards some shards are empty. Columns not named are not read, so their names may clash.
    """
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
                               .cast("binary")), 1, HASH_DIGITS)
    stratum = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    kept = [F.col(name).alias(f"c{i}") for i, name in enumerate((key, source, *carry))]
    names = [f"c{i}" for i in range(len(kept))]
    drawn = rows.select(*kept, stratum.alias("stratum"), F.conv(digits, 16, 10).cast("bigint").alias("draw"))
    drawn = drawn.withColumn("bucket", F.shiftright("draw", 4 * HASH_DIGITS - BUCKET_BITS).cast("int"))

    in_source = Window.partitionBy("stratum")
    counts = (drawn.groupBy("stratum", "bucket").agg(F.count(F.lit(1)).alias("here"))
              .select("stratum", "bucket", F.sum("here").over(in_source).alias("of_source"),
                      (F.sum("here").over(in_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
                       - F.col("here")).alias("before")))
    in_bucket = Window.partitionBy("stratum", "bucket").orderBy("draw", *names)
    ranked = (drawn.withColumn("place", F.row_number().over(in_bucket))
              .join(counts, ["stratum", "bucket"])
              .withColumn("odd", 2 * (F.col("before") + F.col("place")) - 1)
              .withColumn("run", F.expr(f"cast((odd * {BUCKETS}) div (2 * of_source) as int)"))
              .withColumn("fraction", F.col("odd") / (2 * F.col("of_source")))
              .select(*names, "stratum", "draw", "run", "fraction"))
    ranked = staged(ranked, "interleave")

    # one row per bucket of fractions: at most BUCKETS rows
    runs = (ranked.groupBy("run").agg(F.count(F.lit(1)).alias("here"))
            .select("run", F.sum("here").over(Window.partitionBy()).alias("whole"),
                    (F.sum("here").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, 0))
                     - F.col("here")).alias("before")))
    in_run = Window.partitionBy("run").orderBy("fraction", "stratum", "draw", *names)
    placed = (ranked.withColumn("place", F.row_number().over(in_run))
              .join(F.broadcast(runs), "run")
              .withColumn("position", F.col("before") + F.col("place") - 1)
              .withColumn("shard", F.expr(f"cast((position * {shards}) div whole as int)")))
    slot = F.expr(f"position - (shard * whole + {shards - 1}) div {shards}")
    out = [F.col(f"c{i}").alias(name) for i, name in enumerate((key, source, *carry))]
    return placed.select(*out, "shard", slot.alias("slot"))


def write_shards(rows: DataFrame, path: str) -> None:
    """Writes every shard as a folder of its own, in the order of its slots; large shards may be several files."""
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
