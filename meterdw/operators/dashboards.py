"""Dashboard and monitoring reads over the serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.functions.measures import as_column, column_avg, exact_avg
from meterdw.operators.serving import top_n
from meterdw.schemas import MEASURE_TYPES


def status_summary(monitor: DataFrame) -> DataFrame:
    """Devices per status and their share in percent, most frequent first; both run over the handful of statuses."""
    counts = monitor.groupBy("status").agg(F.count("*").alias("device_count"))
    share = exact_avg("device_count * 100", "SUM(device_count) OVER (PARTITION BY 1)", "decimal(5,1)")
    return counts.withColumn("percentage", share).orderBy(F.desc("device_count"), "status")


def latest_devices(monitor: DataFrame, n: int = 8) -> DataFrame:
    columns = monitor.select("device_id", "device_code", "substation_name", "latest_voltage", "latest_power",
                             "temperature", "health_score", "status", "last_update_time")
    return top_n(columns, [F.desc("last_update_time"), F.col("device_id")], n)


def recent_substations(windows: DataFrame, since, n: int = 6) -> DataFrame:
    """Newest substation windows starting at or after `since`."""
    rows = windows.where(F.col("window_start") >= as_column(since)).select(
        "substation_name", "total_devices", "active_devices", "warning_devices", "total_power", "avg_voltage",
        "avg_temperature", "window_start")
    return top_n(rows, [F.desc("window_start"), F.col("substation_name")], n)


def window_stats(windows: DataFrame, since) -> DataFrame:
    """One row of totals over the device windows starting at or after `since`."""
    return windows.where(F.col("window_start") >= as_column(since)).agg(
        F.count("*").alias("total_windows"),
        column_avg("reading_count", "decimal(12,2)").alias("avg_readings_per_window"),
        column_avg("avg_voltage", MEASURE_TYPES["voltage"]).alias("overall_avg_voltage"),
        column_avg("avg_power", MEASURE_TYPES["power"]).alias("overall_avg_power"),
        F.coalesce(F.sum("abnormal_count"), F.lit(0)).alias("total_abnormal"))


def newest_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    rows = windows.select("device_id", "device_code", "substation_name", "window_start", "window_end",
                          "reading_count", "avg_voltage", "max_voltage", "avg_power", "abnormal_count")
    return top_n(rows, [F.desc("window_start"), F.col("device_id")], n)


def newest_customer_hours(hours: DataFrame, n: int = 5) -> DataFrame:
    rows = hours.select("customer_id", "customer_name", "stat_date", "stat_hour", "device_count", "total_energy",
                        "peak_power", "avg_power", "power_cost")
    return top_n(rows, [F.desc("stat_date"), F.desc("stat_hour"), F.col("customer_id")], n)


def newest_substation_hours(hours: DataFrame, n: int = 5) -> DataFrame:
    rows = hours.select("substation_id", "substation_name", "stat_date", "stat_hour", "total_devices",
                        "active_devices", "warning_devices", "total_power", "avg_voltage", "avg_temperature",
                        "health_score")
    return top_n(rows, [F.desc("stat_date"), F.desc("stat_hour"), F.col("substation_id")], n)


def newest_device_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    """Newest 5-minute summaries."""
    rows = windows.select("device_id", "stat_time", "reading_count", "avg_voltage", "avg_current", "avg_power",
                          "avg_temperature", "health_score", "status")
    return top_n(rows, [F.desc("stat_time"), F.col("device_id")], n)


def sample_devices(monitor: DataFrame, n: int = 5) -> DataFrame:
    rows = monitor.select("device_id", "device_code", "latest_voltage", "temperature", "health_score", "status")
    return top_n(rows, [F.col("device_id")], n)


def _labelled(counts: DataFrame) -> DataFrame:
    """One (metric, value) row per column of a one-row frame."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in counts.columns)
    return counts.select(F.expr(f"stack({len(counts.columns)}, {pairs}) AS (metric, value)"))


def monitor_counts(readings: DataFrame, alarms: DataFrame, devices: DataFrame, monitor: DataFrame,
                   last_hour, today) -> DataFrame:
    """The monitor report as (metric, value) rows; every table is read once.

    `last_hour` is the moment an hour ago, `today` any moment of the current day.
    """
    last_hour, today = as_column(last_hour), F.to_date(as_column(today))
    of_readings = readings.agg(
        F.count_if(F.col("reading_time") > last_hour).alias("readings_last_hour"),
        F.count_if(F.to_date("reading_time") == today).alias("readings_today"))
    of_alarms = alarms.agg(
        F.count_if(F.col("status") == "ACTIVE").alias("active_alarms"),
        F.count_if(F.to_date("alarm_time") == today).alias("alarms_today"))
    of_devices = devices.agg(F.count_if(F.col("status") != "DELETED").alias("devices"))
    of_monitor = monitor.agg(F.count("*").alias("monitor_records"))
    parts = [_labelled(df) for df in (of_readings, of_alarms, of_devices, of_monitor)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def hour_quality(hours: DataFrame) -> DataFrame:
    """Row count, devices and date range of the hour summary."""
    per_device = hours.groupBy("device_id").agg(
        F.count("*").alias("n"), F.min("stat_date").alias("first"), F.max("stat_date").alias("last"))
    return per_device.agg(F.sum("n").alias("total_records"), F.count("*").alias("unique_devices"),
                          F.min("first").alias("min_date"), F.max("last").alias("max_date"))


def abnormal_hours(hours: DataFrame) -> DataFrame:
    """Hours with a mean voltage out of 200..250; the averages cover just those hours."""
    rows = hours.where((F.col("avg_voltage") < 200) | (F.col("avg_voltage") > 250))
    return rows.agg(
        F.count("*").alias("abnormal_voltage_count"),
        column_avg("avg_voltage", MEASURE_TYPES["voltage"]).alias("overall_avg_voltage"),
        F.max("max_voltage").alias("max_voltage_recorded"), F.min("min_voltage").alias("min_voltage_recorded"))
