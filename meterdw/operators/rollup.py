"""Window summaries per device, substation and customer.

All of them rest on one partial aggregate: graded readings grouped by (device, window),
keeping sums, counts, extremes and abnormal counters. The group-by runs on the bare fact,
before any dimension is joined, so map-side combining shrinks a hot device to one row per
window and task, no dimension text is shuffled, and the joins that follow see
aggregated rows only. Distinct device counts become plain counts of partial rows, and
averages stay exact because sums and counts are carried separately.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterdw.functions import grading, identity, tariff
from meterdw.functions.measures import avg_text
from meterdw.operators.detail import device_dim
from meterdw.operators.joins import BROADCAST_LIMIT, measured_bytes, sized, split_join
from meterdw.schemas import COST_TYPE, MEASURE_TYPES, SUM_TYPE

ADDITIVE = ["n", "voltage_off", "overheated", "power_off", "abnormal", "abnormal_any"]
WINDOW = ["window_start", "window_end"]


# --- the partial aggregate --------------------------------------------------------------------

def _measure_partials(measures) -> list[Column]:
    kinds = {"sum": "SUM", "cnt": "COUNT", "max": "MAX", "min": "MIN"}
    return [F.expr(f"{fn}({m}) AS {m}_{kind}") for m in measures for kind, fn in kinds.items()]


def flags() -> dict[str, str]:
    """The abnormal counters and what they count."""
    return {"voltage_off": grading.VOLTAGE_OFF, "overheated": grading.OVERHEATED, "power_off": grading.POWER_OFF,
            "abnormal": grading.ABNORMAL, "abnormal_any": f"{grading.ABNORMAL} OR {grading.POWER_OFF}"}


def partials(graded: DataFrame, width: str, keys=("device_id",), measures=tuple(MEASURE_TYPES)) -> DataFrame:
    """(keys, tumbling window) partial rows.

    `graded` may be plain graded readings, a stored detail table with more keys, or a
    stream with a watermark on reading_time. In a batch the optimizer prunes what a
    summary does not use; a stream keeps all of it as state, so name the `measures` there.
    """
    counters = [F.expr(f"count_if({condition}) AS {name}") for name, condition in flags().items()]
    rows = graded.groupBy(*keys, F.window("reading_time", width).alias("w")).agg(
        F.expr("COUNT(*) AS n"), *counters, *_measure_partials(measures))
    return rows.selectExpr(*keys, "w.start AS window_start", "w.end AS window_end",
                           *[c for c in rows.columns if c not in (*keys, "w")])


def is_additive(column: str) -> bool:
    return column in ADDITIVE or column.endswith(("_sum", "_cnt"))


def weighted(parts: DataFrame, weight: str) -> DataFrame:
    """Counts every reading `weight` times: additive partials grow, extremes stay."""
    return parts.selectExpr(*[f"{c} * {weight} AS {c}" if is_additive(c) else c
                              for c in parts.columns if c != weight])


def merged(parts: DataFrame, keys) -> DataFrame:
    """Partials of a coarser key, plus distinct device counts (one partial row per device, window and key)."""
    aggs = []
    for c in parts.columns:
        if is_additive(c):
            aggs.append(f"SUM({c}) AS {c}")
        elif c.endswith(("_max", "_min")):
            aggs.append(f"{c[-3:]}({c}) AS {c}")
    return parts.groupBy(*keys).agg(
        F.expr("CAST(COUNT(*) AS INT) AS total_devices"),
        F.expr("CAST(count_if(n > abnormal) AS INT) AS active_devices"),
        F.expr("CAST(count_if(abnormal > 0) AS INT) AS warning_devices"), *map(F.expr, aggs))


# --- dimensions of partial rows ---------------------------------------------------------------

@dataclass
class Dimensions:
    """Dimension tables in the shape the summaries need; joined to partial rows only."""

    devices: DataFrame        # device_dim
    relations: DataFrame      # customer_device
    customers: DataFrame

    @classmethod
    def of(cls, devices, substations, customer_devices, customers) -> "Dimensions":
        return cls(device_dim(devices, substations), customer_devices, customers)

    def per_device(self) -> DataFrame:
        """Device dimension with `copies`, the number of detail rows one reading yields."""
        links = self.relations.groupBy("device_id").agg(F.expr("COUNT(*) AS links"))
        return (self.devices.join(links, "device_id", "left")
                .selectExpr(*self.devices.columns, "CAST(coalesce(links, 1) AS INT) AS copies"))

    def per_owner(self) -> DataFrame:
        """(device, known customer) with `copies`, the number of relations between the two."""
        links = self.relations.groupBy("device_id", "customer_id").agg(F.expr("CAST(COUNT(*) AS INT) AS copies"))
        names = self.customers.selectExpr("id AS customer_id", "customer_name")
        return (links.join(names.where("customer_id > 0"), "customer_id")
                .join(self.devices.select("device_id"), "device_id", "left_semi"))


def with_devices(parts: DataFrame, dims: Dimensions) -> DataFrame:
    """Partial rows with their device columns. A device has one partial row per window, so no key is hot here."""
    return weighted(parts.join(sized(dims.per_device()), "device_id"), "copies")


def with_owners(parts: DataFrame, dims: Dimensions) -> DataFrame:
    """Partial rows once per known owner.

    The owners are the side that may be hot (a device with very many customers): beyond
    broadcast size they are the ones cut into pieces, and the device's few partial rows
    are repeated per piece.
    """
    owners = dims.per_owner()
    if measured_bytes(owners) <= BROADCAST_LIMIT:
        joined = parts.join(F.broadcast(owners), "device_id")
    else:
        joined = split_join(owners, parts, "device_id", "inner", spread_by=["customer_id"])
    return weighted(joined, "copies")


# --- output columns of a summary, as SQL text over partial columns ----------------------------

DEVICE_KEYS = ["device_id", "device_code", "device_name", "device_type"]
CALENDAR = ["to_date(window_start) AS stat_date", "hour(window_start) AS stat_hour"]
ABNORMAL = "abnormal AS abnormal_count"
ENERGY = f"CAST(energy_sum AS {SUM_TYPE})"


def avg(measure: str, alias: str | None = None) -> str:
    return f"{avg_text(f'{measure}_sum', f'{measure}_cnt', MEASURE_TYPES[measure])} AS {alias or 'avg_' + measure}"


def total(measure: str, alias: str) -> str:
    return f"CAST({measure}_sum AS {SUM_TYPE}) AS {alias}"


ELECTRIC = [avg("voltage"), "voltage_max AS max_voltage", "voltage_min AS min_voltage",
            avg("current_val", "avg_current"), "current_val_max AS max_current",
            avg("power"), "power_max AS max_power", total("energy", "total_energy")]
DEVICE_MEASURES = ["n AS reading_count", *ELECTRIC, avg("power_factor"), avg("frequency"), avg("temperature"),
                   "temperature_max AS max_temperature", "temperature_min AS min_temperature", avg("health_score")]


# --- summaries; input: partial rows carrying their dimension columns ---------------------------

def device_hour(parts: DataFrame) -> DataFrame:
    """Device x calendar hour; abnormal counts voltage and temperature grades."""
    return parts.selectExpr(*DEVICE_KEYS, "substation_id", "substation_name", *CALENDAR, *DEVICE_MEASURES, ABNORMAL)


def device_hour_tumble(parts: DataFrame) -> DataFrame:
    """Device x tumbling hour; abnormal also counts power grades."""
    return parts.selectExpr(*DEVICE_KEYS, "substation_id", "substation_name", *WINDOW, *CALENDAR, *DEVICE_MEASURES,
                            "abnormal_any AS abnormal_count")


def device_hour_copy(hours: DataFrame) -> DataFrame:
    """The columns of the hour summary that are served."""
    return hours.select(
        *DEVICE_KEYS, "substation_name", "stat_date", "stat_hour", "reading_count", "avg_voltage", "max_voltage",
        "min_voltage", "avg_current", "max_current", "avg_power", "max_power", "total_energy", "avg_temperature",
        "max_temperature", "avg_health_score", "abnormal_count")


def device_5min(parts: DataFrame) -> DataFrame:
    """Device x 5 minutes with the window status."""
    rows = parts.selectExpr("*", avg("health_score"))
    return rows.selectExpr(
        *DEVICE_KEYS, "substation_name", "window_start AS stat_time", "n AS reading_count",
        avg("voltage"), avg("current_val", "avg_current"), avg("power"), avg("temperature"),
        "avg_health_score AS health_score",
        f"{grading.window_status_text('voltage_off', 'overheated', 'power_off')} AS status")


def device_30s(parts: DataFrame) -> DataFrame:
    """Device x short window, generated names."""
    named = identity.with_generated_names(parts)
    return named.selectExpr(*DEVICE_KEYS, "substation_name", *WINDOW, "n AS reading_count", *ELECTRIC,
                            avg("temperature"), "temperature_max AS max_temperature", avg("health_score"), ABNORMAL)


def device_20s(parts: DataFrame, layer: str = "DWS-汇总数据层") -> DataFrame:
    """Device x 20 seconds of the two-substation variant."""
    named = identity.with_generated_names(parts, identity.TWO_SUBSTATIONS, identity.PLAIN_METER)
    return named.selectExpr(
        "device_id", "device_code", "substation_name", *WINDOW, "n AS record_count",
        avg("voltage"), "voltage_max AS max_voltage", "voltage_min AS min_voltage",
        avg("temperature"), "temperature_max AS max_temperature", avg("health_score"),
        ABNORMAL, f"'{layer}' AS layer_info")


def device_30s_simple(parts: DataFrame, layer: str = "DWS-汇总数据层") -> DataFrame:
    named = identity.with_generated_names(parts, identity.TWO_SUBSTATIONS, identity.PLAIN_METER)
    return named.selectExpr(
        "device_id", "device_code", "substation_name", avg("voltage"), avg("temperature"), avg("health_score"),
        "n AS record_count", f"'{layer}' AS layer_info", *WINDOW)


def substation_hour(parts: DataFrame) -> DataFrame:
    """Substation x calendar hour; the alarm count is a constant 0 here."""
    rows = merged(parts, ["substation_id", "substation_name", *WINDOW])
    return rows.selectExpr(
        "substation_id", "substation_name", *CALENDAR, "total_devices", "active_devices",
        total("power", "total_power"), avg("voltage"), avg("temperature"),
        "0L AS alarm_count", avg("health_score", "health_score"))


def substation_hour_tumble(parts: DataFrame) -> DataFrame:
    """Substation x tumbling hour; a device with both good and bad readings counts as active and as warning."""
    rows = merged(parts, ["substation_id", "substation_name", *WINDOW])
    return rows.selectExpr(
        "substation_id", "substation_name", *CALENDAR, "total_devices", "active_devices", "warning_devices",
        "0 AS fault_devices", total("power", "total_power"), avg("voltage"), avg("current_val", "avg_current"),
        avg("temperature"), "0L AS alarm_count", avg("health_score", "health_score"))


def substation_30s(parts: DataFrame) -> DataFrame:
    """Substation (by generated name) x short window."""
    named = parts.withColumn("substation_name", identity.substation_for(identity.THREE_SUBSTATIONS))
    rows = merged(named, ["substation_name", *WINDOW])
    return rows.selectExpr("substation_name", *WINDOW, "total_devices", "active_devices", "warning_devices",
                           total("power", "total_power"), avg("voltage"), avg("temperature"), avg("health_score"))


def _customer_hours(parts: DataFrame, cost: str) -> DataFrame:
    rows = merged(parts, ["customer_id", "customer_name", *WINDOW]).selectExpr("*", *CALENDAR)
    return identity.with_customer_labels(rows).selectExpr(
        "customer_id", "customer_code", "customer_name", "customer_type", "stat_date", "stat_hour",
        "total_devices AS device_count", total("energy", "total_energy"), "power_max AS peak_power", avg("power"),
        f"CAST({cost} AS {COST_TYPE}) AS power_cost")


def customer_hour(parts: DataFrame) -> DataFrame:
    """Customer x calendar hour at the flat price."""
    return _customer_hours(parts, tariff.flat_cost(ENERGY))


def customer_hour_time_of_use(parts: DataFrame) -> DataFrame:
    """Customer x tumbling hour at the time-of-use price."""
    return _customer_hours(parts, tariff.time_of_use_cost("stat_hour", ENERGY))


def customer_daily(parts: DataFrame) -> DataFrame:
    """Customer x day: averages over readings, cost as the sum of the hourly time-of-use costs."""
    cost = tariff.time_of_use_cost("hour(window_start)", ENERGY)
    hourly = parts.selectExpr("*", "to_date(window_start) AS stat_date", f"{cost} AS cost_sum")
    rows = merged(hourly, ["customer_id", "customer_name", "stat_date"])
    return identity.with_customer_labels(rows).selectExpr(
        "customer_id", "customer_code", "customer_name", "customer_type", "stat_date",
        total("energy", "total_energy"), "power_max AS peak_power", avg("power"),
        f"CAST(cost_sum AS {COST_TYPE}) AS power_cost")
