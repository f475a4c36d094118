"""Serving layer: latest states, overviews, alarm statistics, top-n listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterdw.functions import grading
from meterdw.functions.measures import column_avg, exact_avg, stat_date, stat_hour
from meterdw.operators import rollup
from meterdw.operators.detail import DEVICE, MEASURES, monitor_columns
from meterdw.operators.joins import BROADCAST_LIMIT, measured_bytes, sized
from meterdw.schemas import MEASURE_TYPES, SUM_TYPE


# --- latest and top-n ---------------------------------------------------------------------------

def latest(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """The first row per key by the `newest` ordering.

    The rank filter lets Spark keep one row per key and task before the shuffle, so a hot
    key does not pile up in one place.
    """
    order = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ordered_rows(df: DataFrame) -> DataFrame:
    """Whole table in id order: a range-partitioned sort, never a single task."""
    return df.orderBy("id")


def newest_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """The n rows with the highest ids."""
    return top_n(df, [F.desc("id")], n)


def point_lookup(df: DataFrame, key: str, value, columns: list[str]) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).select(*columns)


def keyed_lookup(df: DataFrame, key: str, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Point lookups for a whole set of keys at once."""
    return df.join(wanted.select(key).distinct(), key, "left_semi").select(*columns)


def latest_readings(readings: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Newest reading per device; of two with the same time the higher id.

    The newest times are a hash aggregate of two columns. Only the readings at those times, mostly one per device, are
    read in full and ranked, so the fact itself is never sorted or, while the times measure small, shuffled.

    `known` names devices (device_id) and only serves speed: it bounds the times that are broadcast, so that building
    this reads `known` and not the readings. Readings of other devices are all ranked, as are all readings where `known`
    is beyond broadcast size: every task then sorts its own and sends one per device. Without `known` the times are
    measured themselves, which reads two columns of the fact.
    """
    order = [F.desc("reading_time"), F.desc("id")]
    times = readings.groupBy(F.col("device_id").alias("_device")).agg(F.max("reading_time").alias("_newest"))
    same_device = F.col("device_id").eqNullSafe(F.col("_device"))
    if known is None:
        newest = same_device & F.col("reading_time").eqNullSafe(F.col("_newest"))
        return latest(readings.join(sized(times), newest, "left_semi"), ["device_id"], order)
    devices = known.select(F.col("device_id").alias("_device"))
    if measured_bytes(devices.withColumn("_newest", F.lit(0))) > BROADCAST_LIMIT:
        return latest(readings, ["device_id"], order)
    bounded = F.broadcast(times.join(F.broadcast(devices), "_device", "left_semi"))
    rows = readings.join(bounded, same_device, "left").where("_newest IS NULL OR reading_time = _newest")
    return latest(rows.drop("_device", "_newest"), ["device_id"], order)


# --- device monitor ---------------------------------------------------------------------------------

def device_monitor(readings: DataFrame, dim: DataFrame, profile=grading.MAIN) -> DataFrame:
    """Latest graded state per device. Ranks the bare readings first; only the winners are joined and graded."""
    rows = grading.grade(latest_readings(readings, dim).join(sized(dim), "device_id"), profile)
    return rows.select(*monitor_columns(grading.graded_status()))


def batch_device_states(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Latest state per device under the batch rules: 0 and NULL count as not measured."""
    rows = latest_readings(readings, dim).join(sized(dim), "device_id")
    return (grading.grade(rows, grading.BATCH)
            .withColumn("status", grading.reading_status(zero_is_missing=True))
            .select(*DEVICE, "substation_id", "substation_name", "reading_time", *MEASURES, "health_score", "status"))


def substation_rollup(states: DataFrame) -> DataFrame:
    """Substation overview from one state row per device; averages skip missing values and default to 0."""
    def mean(column):
        value = f"NULLIF({column}, 0)"
        return F.coalesce(column_avg(value, MEASURE_TYPES[column]), F.lit(0).cast(MEASURE_TYPES[column]))

    return states.groupBy("substation_id", "substation_name").agg(
        F.expr("CAST(COUNT(*) AS INT) AS total_devices"),
        F.expr("CAST(count_if(status = 'NORMAL') AS INT) AS normal_devices"),
        F.expr("CAST(count_if(status <> 'NORMAL') AS INT) AS warning_devices"),
        F.expr(f"CAST(coalesce(SUM(power), 0) AS {SUM_TYPE}) AS total_power"),
        mean("voltage").alias("avg_voltage"), mean("temperature").alias("avg_temperature"))


def substation_overview(hours: DataFrame) -> DataFrame:
    """Latest calendar hour per substation; warning is total minus active, the alarm columns are constant 0."""
    rows = latest(hours, ["substation_id"], [F.desc("stat_date"), F.desc("stat_hour")])
    return rows.select(
        "substation_id", "substation_name", "total_devices", F.col("active_devices").alias("normal_devices"),
        (F.col("total_devices") - F.col("active_devices")).alias("warning_devices"),
        F.lit(0).alias("fault_devices"), "total_power", "avg_voltage",
        F.lit(0).cast(MEASURE_TYPES["current_val"]).alias("avg_current"), "avg_temperature",
        F.lit(0).alias("active_alarms"))


# --- alarms -----------------------------------------------------------------------------------------------

def alarm_statistics(alarms: DataFrame, devices: DataFrame) -> DataFrame:
    """Alarm counts and mean resolution minutes per hour, substation, device type, alarm type and level.

    Alarms are counted per device first; `devices` is a device dimension.
    """
    resolved = F.col("status") == "RESOLVED"
    # interval arithmetic on zone-less times, independent of the session time zone
    seconds = F.when(resolved, F.expr("CAST(CAST(resolved_time - alarm_time AS INTERVAL SECOND) AS BIGINT)"))
    per_device = (alarms
                  .withColumns({"alarm_date": stat_date("alarm_time"), "alarm_hour": stat_hour("alarm_time")})
                  .groupBy("device_id", "alarm_date", "alarm_hour", "alarm_type", "alarm_level")
                  .agg(F.count("*").alias("n"), F.count_if(resolved).alias("done"),
                       F.sum(seconds).alias("secs"), F.count(seconds).alias("timed")))
    keys = ["alarm_date", "alarm_hour", "substation_id", "substation_name", "device_type", "alarm_type", "alarm_level"]
    return (per_device.join(sized(devices), "device_id").groupBy(*keys)
            .agg(F.sum("n").cast("int").alias("alarm_count"), F.sum("done").cast("int").alias("resolved_count"),
                 exact_avg("SUM(secs)", "SUM(timed) * 60", "decimal(10,2)").alias("avg_resolution_time")))


def substation_hour_with_alarms(hours: DataFrame, alarms: DataFrame, devices: DataFrame) -> DataFrame:
    """Fills alarm_count and fault_devices of the tumbling substation hours.

    A faulty device has an ACTIVE alarm of level ERROR or CRITICAL in that hour. Alarms
    are aggregated before the join, so no reading is counted twice.
    """
    faulty = (F.col("status") == "ACTIVE") & F.col("alarm_level").isin("ERROR", "CRITICAL")
    per_device = (alarms.withColumns({"stat_date": stat_date("alarm_time"), "stat_hour": stat_hour("alarm_time")})
                  .groupBy("device_id", "stat_date", "stat_hour")
                  .agg(F.count("*").alias("n"), F.count_if(faulty).alias("faults")))
    keys = ["substation_id", "stat_date", "stat_hour"]
    per_station = (per_device.join(sized(devices.select("device_id", "substation_id")), "device_id").groupBy(*keys)
                   .agg(F.sum("n").alias("alarms"), F.count_if(F.col("faults") > 0).alias("faulty")))
    rows = hours.drop("alarm_count", "fault_devices").join(per_station, keys, "left")
    return rows.withColumns({
        "alarm_count": F.coalesce("alarms", F.lit(0).cast("long")),
        "fault_devices": F.coalesce("faulty", F.lit(0).cast("long")).cast("int")}).drop("alarms", "faulty")


# --- per-device statistics over raw readings --------------------------------------------------------------

def _of_device(readings: DataFrame, device_id) -> DataFrame:
    return readings if device_id is None else readings.where(F.col("device_id") == device_id)


def device_stats(readings: DataFrame, device_id: int | None = None) -> DataFrame:
    """Reading count, mean voltage and top temperature, of one device or of each."""
    return _of_device(readings, device_id).groupBy("device_id").agg(
        F.count("*").alias("total_readings"),
        column_avg("voltage", MEASURE_TYPES["voltage"]).alias("avg_voltage"),
        F.max("temperature").alias("max_temp"))


def raw_hours(readings: DataFrame, device_id: int | None = None, since=None) -> DataFrame:
    """Hourly aggregate of raw readings per device, without dimensions or grades."""
    rows = _of_device(readings, device_id)
    if since is not None:
        rows = rows.where(F.col("reading_time") >= since)
    means = [column_avg(m, MEASURE_TYPES[m]).alias(alias) for m, alias in (
        ("voltage", "avg_voltage"), ("current_val", "avg_current"), ("power", "avg_power"),
        ("temperature", "avg_temperature"))]
    # a window, not date_trunc: that one would pass through the session time zone
    hours = rows.groupBy("device_id", F.window("reading_time", "1 hour").alias("w")).agg(
        F.count("*").alias("reading_count"), *means)
    return hours.select("device_id", F.col("w.start").alias("hour_time"), *hours.columns[2:])


def raw_hour_listing(readings: DataFrame, device_id: int | None = None, since=None) -> DataFrame:
    """`raw_hours` in order of device and hour."""
    return raw_hours(readings, device_id, since).orderBy("device_id", "hour_time")


def device_hour_listing(hours: DataFrame, since=None, device_id: int | None = None) -> DataFrame:
    rows = _of_device(hours, device_id)
    if since is not None:
        rows = rows.where(F.col("stat_date") >= since)
    return rows.select("device_id", "stat_date", "stat_hour", "reading_count", "avg_voltage", "avg_current",
                       "avg_power", "avg_temperature", "avg_health_score").orderBy("device_id", "stat_date", "stat_hour")


def readings_per_device(readings: DataFrame) -> DataFrame:
    """How many readings every device has, in order of the device."""
    return readings.groupBy("device_id").agg(F.count("*").alias("records")).orderBy("device_id")


# --- master data listings ------------------------------------------------------------------------------------

def devices_with_substation(devices: DataFrame, substations: DataFrame) -> DataFrame:
    stations = substations.select(F.col("id").alias("substation_id"), F.col("name").alias("substation_name"))
    return (devices.join(stations, "substation_id")
            .select(F.col("id").alias("device_id"), "device_name", "device_type", "substation_name"))


def customer_devices(customers: DataFrame, relations: DataFrame, devices: DataFrame) -> DataFrame:
    """Customer, device and relationship of every relation with both ends known."""
    who = customers.select(F.col("id").alias("customer_id"), "customer_name")
    what = devices.select(F.col("id").alias("device_id"), "device_name")
    return (relations.join(who, "customer_id").join(what, "device_id")
            .select("customer_id", "customer_name", "device_id", "device_name", "relationship_type"))


# --- summaries straight from readings ------------------------------------------------------------------------

def window_parts(readings: DataFrame, profile=grading.MAIN, width: str = "1 hour") -> DataFrame:
    """Graded per-device partial rows, the common input of the summaries."""
    return rollup.partials(grading.grade(readings, profile), width)
