"""Change handling over whole tables: apply a change log, conditional updates, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterdw.functions.measures import as_column
from meterdw.operators.serving import latest

DELETE = "d"


def apply(changes: DataFrame, keys: list[str], seq: str = "seq", op: str = "op",
          base: DataFrame | None = None) -> DataFrame:
    """Current rows after a change log: the last image per key, none if the last change is a delete.

    Rows of `base` count as older than any change.
    """
    rows = changes
    if base is not None:
        older = base.withColumns({op: F.lit("c"), seq: F.lit(None).cast(changes.schema[seq].dataType)})
        rows = changes.unionByName(older)
    last = latest(rows, keys, [F.desc_nulls_last(seq)])
    return last.where(F.col(op) != DELETE).drop(op)


def insert_rows(df: DataFrame, new: DataFrame) -> DataFrame:
    return df.unionByName(new)


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE: a condition that is NULL leaves the row alone; types stay as declared."""
    return df.withColumns({
        name: F.when(condition, value).otherwise(F.col(name)).cast(df.schema[name].dataType)
        for name, value in assignments.items()})


def update_keyed(df: DataFrame, updates: DataFrame, key: str, seq: str | None = None) -> DataFrame:
    """Overwrites the columns of `updates` in the rows it names.

    With a sequence column the newest update of a key counts; without one, a key that occurs twice is an error.
    """
    changed = [c for c in updates.columns if c not in (key, seq)]
    if seq is not None:
        updates = latest(updates, [key], [F.desc_nulls_last(seq)])
        renamed = updates.select(key, F.struct(*changed).alias("_new"))
    else:
        twice = F.raise_error(F.concat(F.lit(f"several updates of {key} "), F.col(key).cast("string")))
        renamed = updates.groupBy(key).agg(F.first(F.struct(*changed)).alias("_new"), F.count("*").alias("_n")).select(
            key, F.when(F.col("_n") == 1, F.col("_new")).otherwise(twice).alias("_new"))
    joined = df.join(renamed, key, "left")
    return joined.withColumns({
        c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in changed
    }).select(*df.columns)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The kept side of DELETE ... WHERE: rows where the condition is false or NULL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(gone, keys, "left_anti")


def correct_voltage(readings: DataFrame, device_id: int | None = None, below: str = "220",
                    factor: str = "1.02") -> DataFrame:
    """Raises low voltages by a factor, of one device or of all."""
    low = F.col("voltage") < F.lit(below).cast("decimal(8,2)")
    if device_id is not None:
        low = low & (F.col("device_id") == device_id)
    return update_where(readings, low, {"voltage": F.col("voltage") * F.lit(factor).cast("decimal(3,2)")})


def resolve_alarms(alarms: DataFrame, condition: Column, as_of) -> DataFrame:
    return update_where(alarms, condition, {"resolved_time": as_column(as_of), "status": F.lit("RESOLVED")})


def maintenance_substations(substations: DataFrame, devices: DataFrame) -> DataFrame:
    """Substations with a device in MAINTENANCE change to that status."""
    busy = devices.where(F.col("status") == "MAINTENANCE").select(F.col("substation_id").alias("id")).distinct()
    flagged = substations.join(busy.withColumn("_busy", F.lit(True)), "id", "left")
    return update_where(flagged, F.col("_busy"), {"status": F.lit("MAINTENANCE")}).select(*substations.columns)


def soft_delete(df: DataFrame, condition: Column) -> DataFrame:
    return update_where(df, condition, {"status": F.lit("DELETED")})


def not_deleted(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") != "DELETED")


def retain(df: DataFrame, ts: str, since, only: Column | None = None) -> DataFrame:
    """Drops rows (of those matching `only`) older than `since`; rows without a time stay."""
    kept = (F.col(ts) >= as_column(since)) | F.col(ts).isNull()
    return df.where(kept if only is None else kept | ~F.coalesce(only, F.lit(False)))


def deletable(parents: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """Parents no child row refers to."""
    return parents.join(children.select(F.col(fk).alias(pk)).distinct(), pk, "left_anti")
