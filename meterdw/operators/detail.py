"""Detail layer: readings enriched with their dimensions and graded.

The dimensions are joined to each other first, into one table keyed by device, so the
fact meets a single join on a single key whatever the sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.functions import grading, identity
from meterdw.functions.measures import as_column
from meterdw.operators.joins import lookup_join

MEASURES = ["voltage", "current_val", "power", "energy", "power_factor", "frequency", "temperature"]
GRADES = ["health_score", "voltage_status", "temperature_status", "power_status"]
DEVICE = ["device_id", "device_code", "device_name", "device_type"]


# --- dimensions --------------------------------------------------------------------------

def device_dim(devices: DataFrame, substations: DataFrame) -> DataFrame:
    """One row per device that has a known substation."""
    stations = substations.select(F.col("id").alias("substation_id"), F.col("name").alias("substation_name"))
    return (devices.withColumnRenamed("id", "device_id").select(*DEVICE, "substation_id")
            .join(stations, "substation_id").select(*DEVICE, "substation_id", "substation_name"))


def owner_dim(customer_devices: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer-device relation; customer_id is NULL when the customer is unknown."""
    names = customers.select(F.col("id").alias("customer_id"), "customer_name")
    known = names.withColumn("known_id", F.col("customer_id")).hint("merge")
    return (customer_devices.select("device_id", "customer_id").join(known, "customer_id", "left")
            .select("device_id", F.col("known_id").alias("customer_id"), "customer_name"))


def owned_device_dim(devices, substations, customer_devices, customers) -> DataFrame:
    """device_dim with one row per owner; a device without owner keeps one row, customer 0 / Unknown.

    Owned and ownerless devices are built apart: an inner join may be split at run time
    if one device has very many owners, the right side of an outer join may not. No table is
    broadcast because its files are small: nobody has measured them here.
    """
    dim = device_dim(devices, substations.hint("merge"))
    owned = dim.join(owner_dim(customer_devices, customers).hint("merge"), "device_id")
    alone = dim.join(customer_devices.select("device_id").distinct().hint("merge"), "device_id", "left_anti")
    columns = [*dim.columns, "coalesce(customer_id, 0) AS customer_id",
               "coalesce(customer_name, 'Unknown') AS customer_name"]
    return owned.selectExpr(*columns).unionByName(
        alone.selectExpr(*dim.columns, "0 AS customer_id", "'Unknown' AS customer_name"))


# --- enriched detail ------------------------------------------------------------------------

def detail(readings: DataFrame, dim: DataFrame, profile=grading.MAIN, carry: tuple[str, ...] = (),
           limit_bytes: int | None = None) -> DataFrame:
    """Graded readings joined to a device dimension; `carry` names further columns of the reading to keep. A dimension
    that measures up to `limit_bytes` (by default that of all lookups) is broadcast.

    Readings without device or substation drop out. With `owned_device_dim` a reading of
    a device with k owners yields k rows, so device sums over it count the reading k
    times; the validity dates of a relation are ignored.
    """
    owners = [c for c in ("customer_id", "customer_name") if c in dim.columns]
    limit = {} if limit_bytes is None else {"limit_bytes": limit_bytes}
    joined = lookup_join(readings, dim, "device_id", spread_by=["id"], dim_spread_by=owners or None, **limit)
    return grading.grade(joined, profile).select(
        *carry, *DEVICE, "substation_id", "substation_name", *owners, "reading_time", *MEASURES, *GRADES)


def status_detail(readings: DataFrame, dim: DataFrame, health=grading.G1, layer: str = "DWD-明细数据层") -> DataFrame:
    """Enriched readings with health and a single status."""
    joined = lookup_join(readings, dim, "device_id", spread_by=["id"])
    return joined.select(
        "device_id", "device_code", "device_name", "substation_name",
        "voltage", "current_val", "power", "temperature",
        grading.health(health).alias("health_score"), grading.reading_status().alias("status"),
        F.lit(layer).alias("layer_info"))


def generated_detail(readings: DataFrame, profile=grading.GENERATED) -> DataFrame:
    """Graded readings with names made from the device id; no join."""
    named = identity.with_generated_names(readings)
    return grading.grade(named, profile).select(*DEVICE, "substation_name", "reading_time", *MEASURES, *GRADES)


def simple_detail(readings: DataFrame, layer: str = "DWD-明细数据层") -> DataFrame:
    """Two-substation variant of the generated detail."""
    named = identity.with_generated_names(readings, identity.TWO_SUBSTATIONS, identity.PLAIN_METER)
    return named.select(
        *DEVICE, "substation_name", "voltage", "current_val", "power", "temperature",
        grading.health(grading.G1).alias("health_score"),
        grading.band(grading.VS3, "voltage").alias("voltage_status"),
        grading.band(grading.TS3, "temperature").alias("temperature_status"),
        grading.reading_status().alias("status"), F.lit(layer).alias("layer_info"))


def simple_monitor(readings: DataFrame, layer: str = "ADS-应用数据层") -> DataFrame:
    """Per-reading monitor rows of the two-substation variant."""
    named = identity.with_generated_names(readings, identity.TWO_SUBSTATIONS, identity.PLAIN_METER)
    return named.select(
        "device_id", "device_code", "substation_name", F.col("voltage").alias("latest_voltage"),
        F.col("temperature").alias("latest_temperature"), grading.health(grading.G1).alias("health_score"),
        grading.reading_status().alias("status"), F.lit(layer).alias("layer_info"))


def quick_monitor(readings: DataFrame) -> DataFrame:
    """Code, three measures, quick health and the status without a low-voltage test."""
    return readings.select(
        "device_id", F.expr(identity.padded_code("DEV", "device_id")).alias("device_code"),
        "voltage", "power", "temperature",
        grading.health(grading.G3).alias("health_score"),
        grading.reading_status(low_voltage=False).alias("status"))


def change_monitor(readings: DataFrame, layer: str = "CDC-实时数据层") -> DataFrame:
    """Change-feed smoke output: health without power factor, single status."""
    return readings.select(
        "device_id", "voltage", "temperature", grading.health(grading.G4).alias("health_score"),
        grading.reading_status().alias("status"), F.lit(layer).alias("layer_info"))


def monitor_columns(status) -> list:
    """Projection of a graded or enriched reading to the device monitor."""
    return [*DEVICE, "substation_name",
            F.col("voltage").alias("latest_voltage"), F.col("current_val").alias("latest_current"),
            F.col("power").alias("latest_power"), F.col("energy").alias("latest_energy"),
            "power_factor", "frequency", "temperature", "health_score", status.alias("status"),
            F.col("reading_time").alias("last_update_time")]


def four_level_monitor(detail_rows: DataFrame) -> DataFrame:
    """Every detail row as a monitor row with the four-level status."""
    return detail_rows.select(*monitor_columns(grading.four_level_status()))


def recent_monitor(readings: DataFrame, dim: DataFrame, since) -> DataFrame:
    """Monitor rows of the readings after `since`; the time filter runs before the join and the grading."""
    recent = readings.where(F.col("reading_time") > as_column(since))
    joined = lookup_join(recent, dim, "device_id", spread_by=["id"])
    return (joined.withColumn("health_score", grading.health(grading.G1))
            .select(*monitor_columns(grading.reading_status())))


# --- console projections -----------------------------------------------------------------------

def console_detail(detail_rows: DataFrame) -> DataFrame:
    return detail_rows.select(
        F.lit("DWD-明细层").alias("layer_name"), "device_id", "device_code", "substation_name",
        F.lit("健康度").alias("metric_name"), F.col("health_score").cast("string").alias("metric_value"),
        grading.graded_status().alias("status"))


def console_windows(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.lit("DWS-汇总层").alias("layer_name"), "device_id", "device_code", "substation_name",
        F.lit("30秒平均电压").alias("metric_name"), F.col("avg_voltage").cast("string").alias("metric_value"),
        grading.window_console_status().alias("status"))


def console_graded(detail_rows: DataFrame, layer: str = "DWD-明细数据层") -> DataFrame:
    return detail_rows.select(
        "device_id", "device_code", "substation_name", "voltage", "temperature", "health_score",
        grading.graded_status().alias("status"), F.lit(layer).alias("layer_info"))
