"""The named queries: one callable (spark, data folder) -> DataFrame per operator.

All of them run over the whole tables. Nothing reads the clock: where a query needs "now",
it is the newest reading time, taken by a scalar subquery.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterdw import schemas
from meterdw.functions import grading
from meterdw.functions.measures import newest
from meterdw.operators import changelog, dashboards, detail, quality, rollup, serving
from meterdw.plans.chain import Chain, chain_job
from meterdw.plans.pipelines import devices, dimensions, latest_monitor, owned_devices
from meterdw.session import scratch_dir, utc_session
from meterdw.sinks import files, publish
from meterdw.sinks.versions import KeyedLog, VersionedTable, ddl
from meterdw.sources.tables import Recent, Warehouse
from meterdw.streaming import idle, jobs, source

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Registers a function of the source tables under its own name."""
    REGISTRY[fn.__name__] = lambda spark, folder: fn(Warehouse(spark, folder))
    return fn


# --- sources --------------------------------------------------------------------------------

@query
def ods_meter_reading(wh):
    return wh.meter_reading()


@query
def ods_device_info(wh):
    return wh.device_info()


@query
def ods_substation(wh):
    return wh.substation()


@query
def ods_customer(wh):
    return wh.grid_customer()


@query
def ods_customer_device(wh):
    return wh.customer_device()


@query
def ods_alarm_info(wh):
    return wh.alarm_info()


@query
def ods_device_info_ordered(wh):
    return serving.ordered_rows(wh.device_info())


@query
def ods_latest_1000(wh):
    return serving.newest_rows(wh.meter_reading(), 1000)


@query
def limit_10(wh):
    return (serving.top_n(wh.meter_reading(), [F.col("id")], 10)
            .select("device_id", "voltage", "current_val", "power"))


# --- grades -----------------------------------------------------------------------------------

def _health(wh, rule):
    return wh.meter_reading().select("id", "voltage", "temperature", "power_factor", "frequency",
                                     grading.health(rule).alias("health_score"))


@query
def grade_g1(wh):
    return _health(wh, grading.G1)


@query
def grade_g2(wh):
    return _health(wh, grading.G2)


@query
def grade_g3(wh):
    return _health(wh, grading.G3)


@query
def grade_g4(wh):
    return detail.change_monitor(wh.meter_reading())


@query
def grade_g5(wh):
    return wh.meter_reading().select(
        "id", "voltage", "temperature", "power_factor", grading.health(grading.G5).alias("health_score"),
        grading.reading_status(zero_is_missing=True).alias("status"))


# --- detail -----------------------------------------------------------------------------------

@query
def dwd_device_meter_detail(wh):
    return detail.detail(wh.meter_reading(), owned_devices(wh))


@query
def dwd_no_customer(wh):
    return detail.detail(wh.meter_reading(), devices(wh), grading.STORED_STREAM).drop("substation_id")


@query
def dwd_status_v4(wh):
    return detail.status_detail(wh.meter_reading(), devices(wh))


@query
def dwd_generated(wh):
    return detail.generated_detail(wh.meter_reading())


@query
def dwd_simple(wh):
    return detail.simple_detail(wh.meter_reading())


@query
def quick_monitor(wh):
    return detail.quick_monitor(wh.meter_reading())


def _now(wh, shift: str = ""):
    return newest(wh.meter_reading(), "reading_time", shift)


def _last_days(wh) -> Recent:
    """The tables with the readings of the newest day and the day before it."""
    return Recent(wh, F.to_date(_now(wh, "- INTERVAL 1 DAY")).cast("timestamp_ntz"))


@query
def monitor_recent_hour(wh):
    return detail.recent_monitor(wh.meter_reading(), devices(wh), _now(wh, "- INTERVAL 1 HOUR"))


@query
def ads_device_monitor_4level(wh):
    return detail.four_level_monitor(detail.generated_detail(wh.meter_reading()))


@query
def ads_monitor_simple(wh):
    return detail.simple_monitor(wh.meter_reading())


@query
def console_dwd(wh):
    return detail.console_detail(detail.generated_detail(wh.meter_reading()))


@query
def console_dwd_graded(wh):
    return detail.console_graded(detail.detail(wh.meter_reading(), devices(wh), grading.STORED_STREAM))


@query
def console_dws(wh):
    return detail.console_windows(dws_device_30s(wh))


# --- summaries ----------------------------------------------------------------------------------

def _device_parts(wh, width="1 hour"):
    return rollup.with_devices(serving.window_parts(wh.meter_reading(), width=width), dimensions(wh))


def _owner_parts(wh):
    return rollup.with_owners(serving.window_parts(wh.meter_reading()), dimensions(wh))


@query
def dws_device_hour(wh):
    return rollup.device_hour(_device_parts(wh))


@query
def dws_device_hour_tumble(wh):
    return rollup.device_hour_tumble(_device_parts(wh))


@query
def dws_device_5min(wh):
    return rollup.device_5min(_device_parts(wh, "5 minutes"))


@query
def dws_substation_hour(wh):
    return rollup.substation_hour(_device_parts(wh))


@query
def dws_substation_hour_tumble(wh):
    return rollup.substation_hour_tumble(_device_parts(wh))


@query
def dws_customer_hour(wh):
    return rollup.customer_hour(_owner_parts(wh))


@query
def dws_customer_hour_tou(wh):
    return rollup.customer_hour_time_of_use(_owner_parts(wh))


@query
def customer_power_statistics(wh):
    return rollup.customer_daily(_owner_parts(wh))


def _generated_parts(readings):
    return serving.window_parts(readings, grading.GENERATED, "30 seconds")


@query
def dws_device_30s(wh):
    return rollup.device_30s(_generated_parts(wh.meter_reading()))


@query
def dws_substation_30s(wh):
    return rollup.substation_30s(_generated_parts(wh.meter_reading()))


@query
def dws_device_20s(wh):
    return rollup.device_20s(serving.window_parts(wh.meter_reading(), width="20 seconds"))


@query
def dws_device_30s_simple(wh):
    return rollup.device_30s_simple(serving.window_parts(wh.meter_reading(), width="30 seconds"))


@query
def ads_device_hour_copy(wh):
    return rollup.device_hour_copy(dws_device_hour(wh))


# --- serving --------------------------------------------------------------------------------------

@query
def ads_device_realtime(wh):
    return serving.device_monitor(wh.meter_reading(), devices(wh))


@query
def ads_substation_overview(wh):
    return serving.substation_overview(dws_substation_hour(wh))


@query
def ads_device_states_batch(wh):
    return serving.batch_device_states(wh.meter_reading(), devices(wh))


@query
def ads_substation_overview_batch(wh):
    return serving.substation_rollup(ads_device_states_batch(wh))


@query
def alarm_statistics(wh):
    return serving.alarm_statistics(wh.alarm_info(), devices(wh))


@query
def substation_hour_with_alarms(wh):
    return serving.substation_hour_with_alarms(dws_substation_hour_tumble(wh), wh.alarm_info(), devices(wh))


# --- dashboards -------------------------------------------------------------------------------------

def _latest(wh):
    return serving.latest_readings(wh.meter_reading(), wh.device_info().select(F.col("id").alias("device_id")))


def _generated_monitor(wh):
    return detail.four_level_monitor(detail.generated_detail(_latest(wh)))


def _recent(wh, since) -> DataFrame:
    """Readings that can fall into windows starting at or after `since`, filtered before they are graded."""
    return wh.meter_reading().where(F.col("reading_time") >= since)


@query
def dash_status_summary(wh):
    return dashboards.status_summary(_generated_monitor(wh))


@query
def dash_latest_devices(wh):
    return dashboards.latest_devices(_generated_monitor(wh))


@query
def dash_substation_recent(wh):
    since = _now(wh, "- INTERVAL 5 MINUTES")
    return dashboards.recent_substations(rollup.substation_30s(_generated_parts(_recent(wh, since))), since)


@query
def dash_window_stats(wh):
    since = _now(wh, "- INTERVAL 10 MINUTES")
    return dashboards.window_stats(rollup.device_30s(_generated_parts(_recent(wh, since))), since)


@query
def monitor_counts(wh):
    readings = wh.meter_reading()
    return dashboards.monitor_counts(readings, wh.alarm_info(), wh.device_info(),
                                     readings.select("device_id").distinct(), _now(wh, "- INTERVAL 1 HOUR"), _now(wh))


@query
def window_summary_recent(wh):
    return dashboards.newest_windows(dws_device_30s(wh))


@query
def device_5min_recent(wh):
    since = _now(wh, "- INTERVAL 3 HOURS")
    return dashboards.newest_device_windows(
        dws_device_5min(Recent(wh, since)).where(F.col("stat_time") >= since))


@query
def substation_hour_recent(wh):
    return dashboards.newest_substation_hours(dws_substation_hour_tumble(_last_days(wh)))


@query
def customer_hour_recent(wh):
    return dashboards.newest_customer_hours(dws_customer_hour_tou(_last_days(wh)))


@query
def device_sample(wh):
    return dashboards.sample_devices(ads_device_realtime(wh))


@query
def dws_quality_stats(wh):
    return dashboards.hour_quality(dws_device_hour(wh))


@query
def dws_abnormal_stats(wh):
    return dashboards.abnormal_hours(dws_device_hour(wh))


# --- reads over raw and master data --------------------------------------------------------------------

@query
def raw_hourly_device(wh):
    return serving.raw_hour_listing(wh.meter_reading())


@query
def device_hour_listing(wh):
    return serving.device_hour_listing(dws_device_hour(_last_days(wh)))


@query
def device_stats(wh):
    return serving.device_stats(wh.meter_reading())


@query
def device_latest_reading(wh):
    return _latest(wh).select(
        "device_id", "voltage", "current_val", "power", "temperature", "reading_time")


@query
def readings_per_device(wh):
    return serving.readings_per_device(wh.meter_reading())


@query
def device_with_substation(wh):
    return serving.devices_with_substation(wh.device_info(), wh.substation())


@query
def customer_device_list(wh):
    return serving.customer_devices(wh.grid_customer(), wh.customer_device(), wh.device_info())


@query
def point_lookup(wh):
    alarmed = wh.alarm_info().select(F.col("device_id").alias("id"))
    return serving.keyed_lookup(wh.device_info(), "id", alarmed, ["id", "device_name"])


@query
def table_counts(wh):
    return quality.table_counts({"substation": wh.substation(), "device_info": wh.device_info(),
                                 "meter_reading": wh.meter_reading()})


# --- changes and checks -----------------------------------------------------------------------------------

@query
def cdc_apply_latest(wh):
    return changelog.apply(wh.changelog(), ["account_id"])


@query
def voltage_correction(wh):
    return changelog.correct_voltage(wh.meter_reading()).select("id", "device_id", "voltage")


@query
def alarm_resolve(wh):
    return changelog.resolve_alarms(wh.alarm_info(), F.col("status") == "ACTIVE", _now(wh))


@query
def substation_maintenance_update(wh):
    return changelog.maintenance_substations(wh.substation(), wh.device_info())


@query
def devices_not_deleted(wh):
    return changelog.not_deleted(wh.device_info())


@query
def customers_deletable(wh):
    return changelog.deletable(wh.grid_customer(), "id", wh.customer_device(), "customer_id")


@query
def contact_update(wh):
    """Customers with the phone, email and time of their last update."""
    return changelog.update_keyed(wh.grid_customer(), wh.contact_updates(), "id", "seq")


@query
def retention_readings(wh):
    return changelog.retain(wh.meter_reading(), "reading_time", _now(wh, "- INTERVAL 7 DAYS"))


@query
def retention_alarms(wh):
    since = _now(wh, "+ INTERVAL 10 DAYS - INTERVAL 30 DAYS")
    return changelog.retain(wh.alarm_info(), "resolved_time", since, F.col("status") == "RESOLVED")


@query
def duplicate_keys(wh):
    found = [quality.duplicates(table, [code]).select(F.lit(name).alias("table_name"), F.col(code).alias("code"),
                                                      "occurrences")
             for name, table, code in (("device_info", wh.device_info(), "device_code"),
                                       ("grid_customer", wh.grid_customer(), "customer_code"))]
    return found[0].unionByName(found[1])


@query
def orphan_readings(wh):
    return quality.orphans(wh.meter_reading(), "device_id", wh.device_info(), "id").select(
        "id", "device_id", "reading_time")


@query
def orphan_devices(wh):
    return quality.orphans(wh.device_info(), "substation_id", wh.substation(), "id").select("id", "substation_id")


@query
def orphan_relations(wh):
    ends = (("customer", "customer_id", wh.grid_customer()), ("device", "device_id", wh.device_info()))
    found = [quality.orphans(wh.customer_device(), fk, parent, "id").select("id", F.lit(name).alias("missing"))
             for name, fk, parent in ends]
    return found[0].unionByName(found[1])


@query
def orphan_alarms(wh):
    return quality.orphans(wh.alarm_info(), "device_id", wh.device_info(), "id").select("id", "device_id", "alarm_time")


@query
def reconcile_hour(wh):
    raw = serving.raw_hours(wh.meter_reading()).withColumns(
        {"stat_date": F.to_date("hour_time"), "stat_hour": F.hour("hour_time")})
    return quality.reconcile(raw, dws_device_hour(wh), ["device_id", "stat_date", "stat_hour"],
                             ["reading_count", "avg_voltage", "avg_current", "avg_power", "avg_temperature"])


@query
def reconcile_by_digest(wh):
    """Hours of the readings against stored hours of which every fiftieth reading count is one too high."""
    keys, measures = ["device_id", "stat_date", "stat_hour"], ["reading_count", "avg_voltage", "avg_power"]
    hours = dws_device_hour(wh).select(*keys, *measures)
    wrong = F.expr("pmod(device_id * 31 + stat_hour, 50) = 0")
    served = hours.withColumn("reading_count", F.col("reading_count") + F.when(wrong, 1).otherwise(0))
    return quality.reconcile_ranges(hours, served, keys, measures, "stat_date")


@query
def layer_flow(wh):
    since = _now(wh, "- INTERVAL 1 DAY")
    hours = dws_device_hour(wh).withColumn(
        "hour_time", F.expr("CAST(stat_date AS TIMESTAMP_NTZ) + make_dt_interval(0, stat_hour)"))
    return quality.layer_flow({
        "ods": (wh.meter_reading(), "reading_time"),
        "dwd": (dwd_device_meter_detail(wh), "reading_time"),
        "dws": (hours, "hour_time"),
        "ads": (ads_device_realtime(wh), "last_update_time")}, since)


@query
def upsert_latest_by_key(wh):
    """Readings upserted in two batches, with a compaction between and the second one replayed: corrections win."""
    readings = wh.meter_reading().select("device_id", "reading_time", "voltage", "id")
    corrections = changelog.correct_voltage(readings.where(F.col("voltage") < 220))
    log = KeyedLog(wh.spark, scratch_dir(wh.spark, "upsert"), ddl(readings), ["device_id", "reading_time"],
                   indexed="reading_time")
    log.upsert(readings, 0)
    log.compact()
    for _ in range(2):
        log.upsert(corrections, 1)
    return log.current()


@query
def publish_once(wh):
    """The readings published as a keyed table in two batches, the second one a correction that is sent three times."""
    readings = wh.meter_reading().select("device_id", "reading_time", "voltage", "id")
    corrections = changelog.correct_voltage(readings.where(F.col("voltage") < 220))
    columns = {name: kind for name, kind in schemas.METER_READING.items() if name in readings.columns}
    table = publish.Published(publish.FolderTarget(scratch_dir(wh.spark, "published")), "readings", columns, ("id",))
    for batch_id, batch in enumerate((readings, corrections)):
        for _ in range(1 + 2 * batch_id):
            table.publish(batch, batch_id)
    return table.visible(wh.spark)


@query
def retention_by_file(wh):
    """Readings older than seven days leave a stored table, whole files unread."""
    rows = wh.meter_reading()
    table = VersionedTable(wh.spark, scratch_dir(wh.spark, "retention"), ddl(rows), "reading_time")
    table.append(rows)
    newest_time = dt.datetime.fromisoformat(table.newest())
    table.expire(str(newest_time - dt.timedelta(days=7)))
    return table.read()


@query
def recent_by_file(wh):
    """Readings of the last hour from a stored table: newest time and files come from its records."""
    rows = wh.meter_reading()
    table = VersionedTable(wh.spark, scratch_dir(wh.spark, "recent"), ddl(rows), "reading_time")
    table.append(rows)
    newest_time = dt.datetime.fromisoformat(table.newest())
    return table.read(since=str(newest_time - dt.timedelta(hours=1)))


# --- streams: the whole event table is drained once, the result is the stored output --------------------------

ELECTRIC = ("voltage", "current_val", "power", "energy", "temperature", "health_score")


def _stream(wh):
    """The tables and the reading stream in a UTC session, and a folder for output and checkpoint.

    Stored output has zone-less times, so it is read back in the caller's own session.
    """
    live = Warehouse(utc_session(wh.spark), wh.folder)
    return live, source.reading_stream(live.spark, wh.folder), scratch_dir(wh.spark, "stream")


def _closed_windows(wh, width, summary, profile=grading.MAIN, measures=ELECTRIC):
    """`summary` takes the source tables and the partial rows of a micro-batch."""
    live, readings, root = _stream(wh)
    out = f"{root}/out"
    jobs.window_job(readings, width, {out: lambda parts: summary(live, parts)}, f"{root}/checkpoint", profile,
                    measures).awaitTermination()
    return files.read_batches(wh.spark, out).drop("batch_id")


@query
def stream_tumble_device(wh):
    return _closed_windows(wh, "30 seconds", lambda _, p: rollup.device_30s(p), grading.GENERATED)


@query
def stream_substation_30s(wh):
    return _closed_windows(wh, "30 seconds", lambda _, p: rollup.substation_30s(p), grading.GENERATED)


@query
def stream_device_20s(wh):
    return _closed_windows(wh, "20 seconds", lambda _, p: rollup.device_20s(p),
                           measures=("voltage", "temperature", "health_score"))


@query
def stream_device_5min(wh):
    return _closed_windows(wh, "5 minutes", lambda w, p: rollup.device_5min(rollup.with_devices(p, dimensions(w))))


@query
def stream_substation_hour(wh):
    return _closed_windows(
        wh, "1 hour", lambda w, p: rollup.substation_hour_tumble(rollup.with_devices(p, dimensions(w))))


@query
def stream_customer_hour_tou(wh):
    return _closed_windows(
        wh, "1 hour", lambda w, p: rollup.customer_hour_time_of_use(rollup.with_owners(p, dimensions(w))),
        measures=("power", "energy"))


def _running_hours(wh):
    """The newest partial row of every device and hour; all summaries are made from these."""
    live, readings, root = _stream(wh)
    out = f"{root}/out"
    jobs.running_job(readings, "1 hour", out, f"{root}/checkpoint").awaitTermination()
    return jobs.running_partials(wh.spark, out)


@query
def stream_device_hour(wh):
    return rollup.device_hour(rollup.with_devices(_running_hours(wh), dimensions(wh)))


@query
def stream_substation_hour_running(wh):
    return rollup.substation_hour(rollup.with_devices(_running_hours(wh), dimensions(wh)))


@query
def stream_customer_hour_running(wh):
    return rollup.customer_hour(rollup.with_owners(_running_hours(wh), dimensions(wh)))


@query
def stream_device_hour_idle(wh):
    """Running hours whose state goes an hour after the last reading reached it."""
    live, readings, root = _stream(wh)
    idle.idle_job(readings, "1 hour", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return rollup.device_hour(rollup.with_devices(idle.read_partials(wh.spark, f"{root}/out"), dimensions(wh)))


@query
def stream_latest_device(wh):
    live, readings, root = _stream(wh)
    jobs.latest_job(readings, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return latest_monitor(wh, f"{root}/out")


@query
def stream_limit_10(wh):
    """The first ten readings of the stream: how many there are, and how many of them the table holds.

    Which ones come first is open, so they cannot be compared themselves.
    """
    live, readings, root = _stream(wh)
    jobs.limit_job(readings, 10, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    first = wh.spark.read.schema(schemas.ddl(schemas.METER_READING)).parquet(f"{root}/out").select(
        "id", F.col("device_id").alias("_device"), F.col("voltage").alias("_voltage"))
    # every reading with the same id, so ten rows at most are broadcast and the table is not shuffled
    found = wh.meter_reading().select("id", "device_id", "voltage").join(F.broadcast(first), "id")
    return found.agg(F.count("*").alias("row_count"),
                     F.count_if(F.expr("device_id <=> _device AND voltage <=> _voltage")).alias("known_rows"))


@query
def stream_dwd_enrich(wh):
    live, readings, root = _stream(wh)
    jobs.detail_job(readings, lambda: owned_devices(live), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return files.read_batches(wh.spark, f"{root}/out").drop("batch_id")


@query
def stream_dedup(wh):
    live, readings, root = _stream(wh)
    resent = readings.unionByName(source.reading_stream(live.spark, wh.folder))
    jobs.copy_job(jobs.dedup(resent), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return wh.spark.read.parquet(f"{root}/out")


@query
def stream_cdc_apply(wh):
    """The change log in shuffled files, a third of them sent twice, applied a file a micro-batch."""
    live = Warehouse(utc_session(wh.spark), wh.folder)
    root = scratch_dir(wh.spark, "changes")
    changes = wh.changelog()
    for part in (3, 0, 2, 1, 0):
        changes.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = source.file_stream(live.spark, f"{root}/in", changes.schema, max_files=1)
    jobs.cdc_job(stream, f"{root}/state", ["account_id"], "changed_at", f"{root}/checkpoint").awaitTermination()
    return jobs.cdc_state(wh.spark, f"{root}/state", changes.schema, ["account_id"]).drop("op")


# --- the chain of layers: readings arrive in two deliveries with rows of the same days ---------------------------

def _chain(wh, before=None, **layers) -> Chain:
    """The whole reading table streamed from stored files into the chain, a delivery of any number of files a micro-batch.

    `before` makes the dimension that holds while the first delivery is read, of the one that holds afterwards.
    """
    live = Warehouse(utc_session(wh.spark), wh.folder)
    root = scratch_dir(wh.spark, "chain")
    dim = owned_devices(live)
    known = iter([dim if before is None else before(dim)])
    for part in range(2):
        wh.meter_reading().where(F.col("id") % 2 == part).write.mode("append").parquet(f"{root}/in/meter_reading")
        # the query goes on from its checkpoint: what came since is one micro-batch
        readings = source.stored_stream(live.spark, f"{root}/in", "meter_reading")
        chain_job(readings, f"{root}/layers", f"{root}/checkpoint", lambda: next(known, dim),
                  **layers).awaitTermination()
    return Chain(wh.spark, f"{root}/layers")


def _other_names(dim):
    """The dimension before some substations were renamed, devices changed hands and others became known."""
    station, owner = F.col("substation_id"), F.col("customer_id")
    return dim.where(F.col("device_id") % 10 != 3).withColumns({
        "substation_name": F.when(station % 3 == 0, F.concat(F.lit("old "), "substation_name")).otherwise(
            F.col("substation_name")),
        "customer_id": F.when(owner % 4 == 1, owner + 1).otherwise(owner)})


@query
def stream_dwd_revised(wh):
    return _chain(wh, _other_names, hours=(), states=False).dwd.read().drop("id")


@query
def chain_device_hour(wh):
    return _chain(wh, hours=("dws_device_hour",), states=False).hours["dws_device_hour"].read()


@query
def chain_customer_hour(wh):
    return _chain(wh, _other_names, hours=("dws_customer_hour",), states=False).hours["dws_customer_hour"].read()


@query
def chain_substation_overview(wh):
    chain = _chain(wh, hours=("dws_substation_hour",), states=False)
    chain.advance_overview()
    return chain.overview.read()


@query
def chain_device_monitor(wh):
    chain = _chain(wh, _other_names, hours=(), states=False)
    chain.advance_monitor()
    return chain.device_monitor()
