"""Streams over several micro-batches: equal to batch, late rows, restart, chained layers."""

import datetime as dt
import os
import time

import pytest
from helpers import BASE, readings, seed_dimensions

from meterdw import schemas
from meterdw.functions import grading
from meterdw.operators import detail, rollup, serving
from meterdw.plans import pipelines
from meterdw.plans.queries import REGISTRY
from meterdw.session import scratch_dir
from meterdw.sinks import files
from meterdw.sources.tables import Warehouse
from meterdw.streaming import idle, jobs, source
from pyspark.sql import functions as F

STEP = dt.timedelta(seconds=7)


def deliver(spark, folder, rows, stamp):
    """One source file; file times decide the order of replay."""
    readings(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    for name in os.listdir(folder):
        full = os.path.join(folder, name)
        if name.endswith(".parquet") and os.path.getmtime(full) > time.time() - 3600:
            os.utime(full, (stamp, stamp))


@pytest.fixture
def feed(utc, tmp_path):
    """300 readings of three devices, 7 s apart, in five files in time order."""
    folder = str(tmp_path / "feed")
    old = time.time() - 100_000
    for part in range(5):
        deliver(utc, folder, [{"id": i, "device_id": 1 + i % 3, "reading_time": BASE + i * STEP,
                               "voltage": str(190 + i % 60)} for i in range(part * 60, part * 60 + 60)], old + part)
    return folder


def stream(utc, folder):
    return source.file_stream(utc, folder, schemas.ddl(schemas.METER_READING), max_files=1)


def test_the_first_rows_of_a_stream(utc, feed, tmp_path):
    """The limit holds over micro-batches and a restart, and is met across them."""
    out = lambda: sorted(r.id for r in utc.read.parquet(f"{tmp_path}/out").collect())
    for _ in range(2):
        jobs.limit_job(stream(utc, feed), 70, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
        found = out()
        assert len(set(found)) == len(found) == 70 and set(range(60)) < set(found) < set(range(120))
    deliver(utc, feed, [{"id": 900, "device_id": 1, "reading_time": BASE}], time.time() - 10)
    jobs.limit_job(stream(utc, feed), 70, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert out() == found


def windows_of(utc, out):
    return sorted(files.read_batches(utc, out).drop("batch_id").collect())


def batch_windows(utc, folder, until):
    rows = rollup.device_30s(serving.window_parts(utc.read.parquet(folder), grading.GENERATED, "30 seconds"))
    return sorted(rows.where(F.col("window_end") <= F.lit(until).cast("timestamp_ntz")).collect())


def run_windows(utc, folder, root):
    query = jobs.window_job(stream(utc, folder), "30 seconds", {
        f"{root}/device": rollup.device_30s, f"{root}/station": rollup.substation_30s},
        f"{root}/checkpoint", grading.GENERATED)
    query.awaitTermination()
    return query


def test_windows_equal_batch_on_closed_windows(utc, feed, tmp_path):
    query = run_windows(utc, feed, str(tmp_path / "out"))
    seen = jobs.flow(query)
    assert (seen["batches"], seen["rows"], seen["late_rows"]) == (5, 300, 0) and seen["rows_per_second"] > 0
    closed = BASE + 299 * STEP - dt.timedelta(seconds=5)
    got = windows_of(utc, f"{tmp_path}/out/device")
    assert got == batch_windows(utc, feed, closed) and len(got) > 150
    stations = rollup.substation_30s(serving.window_parts(utc.read.parquet(feed), grading.GENERATED, "30 seconds"))
    expected = stations.where(F.col("window_end") <= F.lit(closed).cast("timestamp_ntz")).collect()
    assert windows_of(utc, f"{tmp_path}/out/station") == sorted(expected)


def test_restart_continues_without_duplicates(utc, feed, tmp_path):
    root = str(tmp_path / "out")
    run_windows(utc, feed, root)
    deliver(utc, feed, [{"id": i, "device_id": 1 + i % 3, "reading_time": BASE + i * STEP,
                         "voltage": str(190 + i % 60)} for i in range(300, 360)], time.time() - 10)
    run_windows(utc, feed, root)
    closed = BASE + 359 * STEP - dt.timedelta(seconds=5)
    assert windows_of(utc, f"{root}/device") == batch_windows(utc, feed, closed)


def test_late_rows_are_dropped_and_counted(utc, feed, tmp_path):
    deliver(utc, feed, [{"id": 900, "device_id": 1, "reading_time": BASE}], time.time() - 10)
    query = run_windows(utc, feed, str(tmp_path / "out"))
    first = files.read_batches(utc, f"{tmp_path}/out/device").where(
        (F.col("window_start") == F.lit(BASE).cast("timestamp_ntz")) & (F.col("device_id") == 1)).collect()
    assert [r["reading_count"] for r in first] == [2]
    assert jobs.flow(query)["late_rows"] == 1


def test_running_hours_are_revised(utc, feed, tmp_path):
    root = str(tmp_path / "out")
    jobs.running_job(stream(utc, feed), "1 hour", f"{root}/hours", f"{root}/checkpoint",
                     grading.MAIN).awaitTermination()
    log = files.read_batches(utc, f"{root}/hours")
    assert log.count() > 3
    got = rollup.device_20s(jobs.running_partials(utc, f"{root}/hours")).collect()
    expected = rollup.device_20s(serving.window_parts(utc.read.parquet(feed))).collect()
    assert sorted(got) == sorted(expected)


def test_running_hours_above_the_device(utc, tmp_path):
    """A micro-batch changes one device; sums over its substation and its owner still hold the others."""
    feed, root, old = str(tmp_path / "feed"), str(tmp_path / "out"), time.time() - 100_000
    for part, device in enumerate((1, 2, 3, 1)):
        deliver(utc, feed, [{"id": 10 * part + i, "device_id": device, "power": str(1000 * (part + 1)),
                             "reading_time": BASE + (10 * part + i) * STEP} for i in range(10)], old + part)
    jobs.running_job(stream(utc, feed), "1 hour", f"{root}/hours", f"{root}/checkpoint").awaitTermination()
    parts = jobs.running_partials(utc, f"{root}/hours")
    whole = serving.window_parts(utc.read.parquet(feed), width="1 hour")
    dims = rollup.Dimensions.of(*seed_dimensions(utc))
    stations = [rollup.substation_hour(rollup.with_devices(p, dims)).collect() for p in (parts, whole)]
    assert sorted(stations[0]) == sorted(stations[1]) and {r["total_devices"] for r in stations[0]} >= {2}
    owners = [rollup.customer_hour(rollup.with_owners(p, dims)).collect() for p in (parts, whole)]
    assert sorted(owners[0]) == sorted(owners[1]) and owners[0]


def test_flow_counts_more_batches_than_a_query_keeps(utc, feed, tmp_path):
    kept = utc.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    utc.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        deliver(utc, feed, [{"id": 900, "device_id": 1, "reading_time": BASE}], time.time() - 10)
        deliver(utc, feed, [{"id": 901, "device_id": 2, "reading_time": BASE + 400 * STEP}], time.time() - 5)
        deliver(utc, feed, [{"id": 902, "device_id": 2, "reading_time": BASE + 500 * STEP}], time.time() - 1)
        query = run_windows(utc, feed, str(tmp_path / "out"))
        assert len(query.recentProgress) <= 2
        seen = jobs.flow(query)
        assert (seen["batches"], seen["rows"], seen["late_rows"]) == (8, 303, 1)
    finally:
        utc.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_dedup_drops_resent_rows(utc, feed, tmp_path):
    deliver(utc, feed, [{"id": i, "reading_time": BASE + i * STEP} for i in range(298, 300)], time.time() - 10)
    out = f"{tmp_path}/out"
    jobs.copy_job(jobs.dedup(stream(utc, feed)), out, f"{tmp_path}/checkpoint").awaitTermination()
    ids = [r["id"] for r in utc.read.parquet(out).select("id").collect()]
    assert sorted(ids) == list(range(300))


def test_dimensions_are_read_per_batch(utc, feed, tmp_path):
    seen = []

    def dim():
        seen.append(1)
        return utc.createDataFrame([(1, "D1", "one", "METER", 1, "North")],
                                   "device_id int, device_code string, device_name string, device_type string, "
                                   "substation_id int, substation_name string")

    jobs.detail_job(stream(utc, feed), dim, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert len(seen) == 5
    assert files.read_batches(utc, f"{tmp_path}/out").count() == 100


def test_chained_layers(utc, folder):
    root = scratch_dir(utc, "layers")
    paths = pipelines.run_stream_layers(utc, folder, root)
    wh = Warehouse(utc, folder)
    assert utc.read.parquet(paths["ods"]).count() == wh.meter_reading().count()
    assert files.read_batches(utc, paths["dwd"]).count() == REGISTRY["dwd_device_meter_detail"](utc, folder).count()
    assert files.read_batches(utc, paths["dws_substation"]).count() > 500
    monitor = pipelines.latest_monitor(wh, paths["ads_latest"])
    expected = serving.device_monitor(wh.meter_reading(), pipelines.devices(wh))
    assert sorted(monitor.collect()) == sorted(expected.collect())


def test_layers_side_by_side(utc, folder):
    root = scratch_dir(utc, "side-by-side")
    paths = pipelines.run_stream_layers(utc, folder, root, every="1 second")
    try:
        deadline = time.time() + 120
        while time.time() < deadline:
            try:
                if files.read_batches(utc, paths["ads_latest"]).count() >= 15:
                    break
            except Exception as error:  # the table does not exist before its first batch
                assert "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER" in str(error)
            time.sleep(1)
        assert files.read_batches(utc, paths["ads_latest"]).count() >= 15
    finally:
        for query in utc.streams.active:
            query.stop()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    assert scratch_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_console_sink(utc, feed, tmp_path):
    query = jobs.console_job(detail.quick_monitor(stream(utc, feed)), f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert jobs.flow(query)["rows"] == 300


def test_idle_windows_go_and_revised_ones_stay(utc, tmp_path):
    """One window is revised all the time, one is left alone: its state goes, and a reading that comes later still counts."""
    feed, out, old = str(tmp_path / "feed"), str(tmp_path / "out"), time.time() - 100_000
    states = []

    def batch(at, rows):
        deliver(utc, feed, [{"id": 100 * at + i, **row} for i, row in enumerate(rows)], old + at)
        query = idle.idle_job(stream(utc, feed), "1 hour", out, f"{tmp_path}/checkpoint", idle_ms=24_000)
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])

    batch(0, [{"device_id": 1, "voltage": None}, {"device_id": 2, "voltage": "250"}])
    begun = time.time()
    for at in (1, 2, 3):
        time.sleep(max(0.0, begun + at * 10 - time.time()))
        batch(at, [{"device_id": 1, "voltage": str(220 + at), "temperature": None}])
    assert states[0] == 2 and states[-1] == 1
    lives = files.read_batches(utc, out).groupBy("device_id").agg(F.countDistinct("born_ms").alias("lives"))
    batch(4, [{"device_id": 2, "voltage": "190", "reading_time": BASE + dt.timedelta(minutes=1)}])
    assert {r.device_id: r.lives for r in lives.collect()}[1] == 1 and states[-1] == 2
    whole = serving.window_parts(utc.read.parquet(feed))
    got = idle.read_partials(utc, out).select(whole.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 2


def test_idle_windows_of_many_devices_share_their_calls(utc, tmp_path):
    """Hundreds of devices of one hour, one unknown and one with readings of nulls: a few states, the sums of a batch."""
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    for at in range(2):
        deliver(utc, feed, [{"id": 1000 * at + i, "device_id": i % 300 or None, "voltage": str(200 + i % 50 + at) if
                             i % 300 != 7 else None, "energy": None} for i in range(400)], time.time() - 100_000 + at)
    query = idle.idle_job(stream(utc, feed), "1 hour", out, f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert 1 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= idle.BUCKETS
    assert files.read_batches(utc, out).count() == 600
    whole = serving.window_parts(utc.read.parquet(feed))
    got = idle.read_partials(utc, out).select(whole.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 300
