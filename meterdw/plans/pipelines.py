"""Whole pipelines: batch build and refresh, and the chained streaming layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw import schemas
from meterdw.operators import detail, rollup, serving
from meterdw.sinks import files
from meterdw.sources.tables import Warehouse
from meterdw.streaming import jobs, source


def dimensions(wh: Warehouse) -> rollup.Dimensions:
    return rollup.Dimensions.of(wh.device_info(), wh.substation(), wh.customer_device(), wh.grid_customer())


def owned_devices(wh: Warehouse) -> DataFrame:
    return detail.owned_device_dim(wh.device_info(), wh.substation(), wh.customer_device(), wh.grid_customer())


def devices(wh: Warehouse) -> DataFrame:
    return detail.device_dim(wh.device_info(), wh.substation())


def build_batch(wh: Warehouse, root: str) -> dict[str, str]:
    """Detail, hour summaries and serving tables, each replaced as a whole. Returns table paths."""
    spark = wh.spark
    paths = {name: f"{root}/{name}" for name in (
        "dwd_detail", "dws_device_parts", "dws_device_hour", "dws_substation_hour", "dws_customer_hour",
        "ads_device_monitor", "ads_substation_overview")}
    readings, dims = wh.meter_reading(), dimensions(wh)
    by_date = ("stat_date",)
    rows = detail.detail(readings, owned_devices(wh)).withColumn("stat_date", F.to_date("reading_time"))
    files.full_refresh(rows, paths["dwd_detail"], partition_by=by_date)
    # all hour summaries derive from one stored pass over the readings
    files.full_refresh(serving.window_parts(readings), paths["dws_device_parts"])
    parts = files.read_published(spark, paths["dws_device_parts"])
    with_devices = rollup.with_devices(parts, dims)
    files.full_refresh(rollup.device_hour(with_devices), paths["dws_device_hour"],
                       unique=("device_id", "stat_date", "stat_hour"), partition_by=by_date)
    files.full_refresh(rollup.substation_hour(with_devices), paths["dws_substation_hour"],
                       unique=("substation_id", "stat_date", "stat_hour"))
    files.full_refresh(rollup.customer_hour(rollup.with_owners(parts, dims)), paths["dws_customer_hour"],
                       unique=("customer_id", "stat_date", "stat_hour"))
    files.full_refresh(serving.device_monitor(readings, devices(wh)), paths["ads_device_monitor"],
                       unique=("device_id",))
    hours = files.read_published(spark, paths["dws_substation_hour"])
    files.full_refresh(serving.substation_overview(hours), paths["ads_substation_overview"],
                       unique=("substation_id",))
    return paths


def refresh_states(wh: Warehouse, root: str, newest: int | None = None) -> dict[str, str]:
    """Batch sync: extract, latest state per device, substation rollup. `newest` limits the extract by id."""
    readings = wh.meter_reading() if newest is None else serving.newest_rows(wh.meter_reading(), newest)
    monitor, overview = f"{root}/device_states", f"{root}/substation_states"
    files.full_refresh(serving.batch_device_states(readings, devices(wh)), monitor, unique=("device_id",))
    states = files.read_published(wh.spark, monitor)
    files.full_refresh(serving.substation_rollup(states), overview, unique=("substation_id",))
    return {"device_states": monitor, "substation_states": overview}


def run_stream_layers(spark: SparkSession, folder: str, root: str, every: str | None = None,
                      max_files: int | None = None) -> dict[str, str]:
    """The chained layers: raw copy, then detail, windows and latest state from the stored copy.

    Every layer is its own query with its own checkpoint, linked to the one before by a
    stored table. Without `every` the layers drain one after the other; with it they run
    side by side and this call returns at once. `spark` must be a UTC session.
    """
    wh = Warehouse(spark, folder)
    paths = {name: f"{root}/{name}" for name in ("ods", "dwd", "dws_device", "dws_substation", "ads_latest")}

    def checkpoint(name: str) -> str:
        return f"{root}/_checkpoints/{name}"

    def settle(query):
        if every is None:
            query.awaitTermination()

    settle(jobs.copy_job(source.reading_stream(spark, folder, max_files), paths["ods"], checkpoint("ods"), every))

    def stored() -> DataFrame:
        return source.file_stream(spark, paths["ods"], schemas.ddl(schemas.METER_READING))

    settle(jobs.detail_job(stored(), lambda: owned_devices(wh), paths["dwd"], checkpoint("dwd"), every=every))
    settle(jobs.window_job(stored(), "1 hour", {
        paths["dws_device"]: lambda p: rollup.device_hour_tumble(rollup.with_devices(p, dimensions(wh))),
        paths["dws_substation"]: lambda p: rollup.substation_hour_tumble(rollup.with_devices(p, dimensions(wh))),
    }, checkpoint("dws"), every=every))
    settle(jobs.latest_job(stored(), paths["ads_latest"], checkpoint("ads"), every))
    return paths


def latest_monitor(wh: Warehouse, path: str) -> DataFrame:
    """Device monitor over the log of the latest-state job."""
    newest = files.read_latest(wh.spark, path, ["device_id"], [F.desc("reading_time"), F.desc("id")])
    return serving.device_monitor(newest, devices(wh))
