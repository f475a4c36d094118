"""Closed-form readings, owner fan-out, exact averages, stored detail as input."""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import BASE, readings, seed_dimensions

from meterdw.functions import grading
from meterdw.functions.measures import before, column_avg
from meterdw.operators import changelog, dashboards, detail, quality, rollup, serving
from pyspark.sql import functions as F


def closed_form(spark):
    """Device 1, one reading a minute for two hours."""
    rows = []
    for i in range(120):
        v, a = Decimal("220") + Decimal("0.5") * (i % 10), Decimal("15") + Decimal("0.2") * (i % 5)
        p = (v * a * Decimal("0.9")).quantize(Decimal("0.01"))
        rows.append({"reading_time": BASE + dt.timedelta(minutes=i), "voltage": v, "current_val": a, "power": p,
                     "energy": (p / 60).quantize(Decimal("0.01")),
                     "temperature": Decimal("45") + Decimal("0.5") * (i % 20)})
    return readings(spark, rows)


def parts_with_devices(spark, rows, width="1 hour"):
    return rollup.with_devices(serving.window_parts(rows, width=width), rollup.Dimensions.of(*seed_dimensions(spark)))


def test_closed_form_hours(spark):
    hours = rollup.device_hour(parts_with_devices(spark, closed_form(spark))).orderBy("stat_hour").collect()
    assert [h["stat_hour"] for h in hours] == [8, 9]
    for h in hours:
        assert (h["reading_count"], h["abnormal_count"]) == (60, 0)
        assert (h["avg_voltage"], h["max_voltage"], h["min_voltage"]) == (
            Decimal("222.25"), Decimal("224.50"), Decimal("220.00"))
        assert (h["avg_current"], h["avg_temperature"], h["avg_health_score"]) == (
            Decimal("15.40"), Decimal("49.75"), Decimal("95.00"))


def test_closed_form_five_minutes(spark):
    rows = rollup.device_5min(parts_with_devices(spark, closed_form(spark), "5 minutes")).collect()
    assert len(rows) == 24 and {r["status"] for r in rows} == {"NORMAL"}


def test_input_order_does_not_matter(spark):
    rows = closed_form(spark)
    a = rollup.device_hour(parts_with_devices(spark, rows)).collect()
    b = rollup.device_hour(parts_with_devices(spark, rows.orderBy(F.desc("id")).repartition(3))).collect()
    assert sorted(a) == sorted(b)


def test_owner_fan_out(spark):
    rows = readings(spark, [{"device_id": d} for d in (1, 3, 4, 6, 50)])
    dim = detail.owned_device_dim(*seed_dimensions(spark))
    got = sorted((r["device_id"], r["customer_id"], r["customer_name"]) for r in detail.detail(rows, dim).collect())
    # no owner, two owners, no substation, unknown customer, unknown device
    assert got == [(1, 0, "Unknown"), (3, 1, "Ann"), (3, 3, "Cy"), (6, 0, "Unknown")]
    hours = {h["device_id"]: (h["reading_count"], h["total_energy"])
             for h in rollup.device_hour(parts_with_devices(spark, rows)).collect()}
    assert hours == {1: (1, Decimal(10)), 3: (2, Decimal(20)), 6: (1, Decimal(10))}


def test_summary_of_stored_detail_equals_summary_of_readings(spark):
    """The eager form (aggregate, then join) against grouping the enriched detail rows."""
    rows = readings(spark, [{"device_id": d, "voltage": str(v), "reading_time": BASE + dt.timedelta(minutes=m)}
                            for d in (1, 2, 3, 5, 6) for v, m in ((150, 0), (220, 10), (245, 61))])
    dims = seed_dimensions(spark)
    stored = detail.detail(rows, detail.owned_device_dim(*dims))
    keys = [*rollup.DEVICE_KEYS, "substation_id", "substation_name"]
    direct = rollup.device_hour(rollup.partials(stored, "1 hour", keys))
    assert sorted(direct.collect()) == sorted(rollup.device_hour(parts_with_devices(spark, rows)).collect())


def test_device_may_be_active_and_warning(spark):
    rows = readings(spark, [{"device_id": 1}, {"device_id": 1, "voltage": "250"}, {"device_id": 2}])
    [station] = rollup.substation_hour_tumble(parts_with_devices(spark, rows)).collect()
    assert (station["total_devices"], station["active_devices"], station["warning_devices"]) == (2, 2, 1)


def test_average_rounds_half_up_once(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),), (None,)], "v decimal(8,2)")
    assert df.agg(column_avg("v", "decimal(8,2)").alias("a")).first()["a"] == Decimal("1.01")
    assert df.where("v IS NULL").agg(column_avg("v", "decimal(8,2)").alias("a")).first()["a"] is None


def test_latest_state_ties_and_batch_rollup(spark):
    rows = readings(spark, [{"device_id": 1, "id": 1, "voltage": "210"}, {"device_id": 1, "id": 2, "voltage": "250"},
                            {"device_id": 2, "id": 3, "voltage": "0"}])
    devices, substations, *_ = seed_dimensions(spark)
    states = serving.batch_device_states(rows, detail.device_dim(devices, substations))
    assert {r["device_id"]: (r["voltage"], int(r["health_score"]), r["status"]) for r in states.collect()} == {
        1: (Decimal("250.00"), 80, "WARNING"), 2: (Decimal("0.00"), 50, "NORMAL")}
    [station] = serving.substation_rollup(states).collect()
    assert (station["total_devices"], station["normal_devices"], station["warning_devices"]) == (2, 1, 1)
    assert station["avg_voltage"] == Decimal("250.00")


def test_recent_windows_are_found(spark):
    rows = readings(spark, [{"reading_time": BASE + dt.timedelta(minutes=m)} for m in range(30)])
    windows = rollup.device_30s(serving.window_parts(rows, grading.GENERATED, "30 seconds"))
    now = BASE + dt.timedelta(minutes=29)
    assert dashboards.window_stats(windows, before(now, "10 MINUTES")).first()["total_windows"] == 11
    stations = rollup.substation_30s(serving.window_parts(rows, grading.GENERATED, "30 seconds"))
    assert dashboards.recent_substations(stations, before(now, "5 MINUTES")).count() == 6


def test_point_reads(spark):
    devices, substations, relations, customers = seed_dimensions(spark)
    assert serving.point_lookup(devices, "id", 3, ["device_name"]).collect()[0][0] == "three"
    rows = readings(spark, [{"device_id": 1}, {"device_id": 2}])
    assert serving.device_stats(rows, 1).count() == 1
    assert serving.raw_hours(rows, 2, since=BASE).first()["reading_count"] == 1
    assert serving.devices_with_substation(devices, substations).where("device_id = 5").first()[
        "substation_name"] == "West"
    assert {r["device_id"] for r in serving.customer_devices(customers, relations, devices)
            .where("customer_id = 3").collect()} == {3}


# --- changes ------------------------------------------------------------------------------

def test_apply_changes_on_a_base(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    changes = spark.createDataFrame(
        [("u", 10, 1, "a2"), ("d", 11, 2, "b"), ("c", 12, 4, "d"), ("u", 13, 4, "d2"), ("d", 5, 1, "a"),
         ("d", 14, 5, "x")], "op string, seq long, id int, v string")
    got = {r["id"]: r["v"] for r in changelog.apply(changes, ["id"], base=base).collect()}
    assert got == {1: "a2", 3: "c", 4: "d2"}


def test_updates_and_deletes(spark):
    devices, substations, relations, customers = seed_dimensions(spark)
    rows = readings(spark, [{"voltage": "219.99"}, {"voltage": "220"}, {"voltage": None}])
    assert [r["voltage"] for r in changelog.correct_voltage(rows, 1).orderBy("id").collect()] == [
        Decimal("224.39"), Decimal("220.00"), None]
    assert changelog.correct_voltage(rows, 2).where("voltage = 219.99").count() == 1
    assert changelog.correct_voltage(rows).schema == rows.schema
    new = spark.createDataFrame([(2, "Bo")], "id int, customer_name string")
    assert {r["customer_name"] for r in changelog.update_keyed(customers, new, "id").collect()} == {"Ann", "Bo", "Cy"}
    twice = spark.createDataFrame([(2, "Bo", 5), (2, "Bob", 7), (9, "Nobody", 1)], "id int, customer_name string, seq int")
    newest = changelog.update_keyed(customers, twice, "id", "seq")
    assert sorted(r["customer_name"] for r in newest.collect()) == ["Ann", "Bob", "Cy"]
    with pytest.raises(Exception, match="several updates of id 2"):
        changelog.update_keyed(customers, twice.drop("seq"), "id").collect()
    gone = spark.createDataFrame([(2,)], "id int")
    assert changelog.delete_keys(relations, gone, ["id"]).count() == 3
    assert changelog.not_deleted(changelog.soft_delete(devices, F.col("id") == 1)).count() == 4
    assert {r["id"]: r["status"] for r in changelog.maintenance_substations(substations, devices).collect()} == {
        1: "MAINTENANCE", 2: "ACTIVE", 3: "ACTIVE"}
    assert {r["id"] for r in changelog.deletable(customers, "id", relations, "customer_id").collect()} == set()
    assert changelog.insert_rows(customers, customers).count() == 6


def test_retention_keeps_rows_without_time(spark):
    rows = spark.createDataFrame([(1, BASE, "RESOLVED"), (2, BASE, "ACTIVE"), (3, None, "RESOLVED")],
                                 "id int, t timestamp_ntz, status string")
    since = BASE + dt.timedelta(days=1)
    assert {r["id"] for r in changelog.retain(rows, "t", since).collect()} == {3}
    assert {r["id"] for r in changelog.retain(rows, "t", since, F.col("status") == "RESOLVED").collect()} == {2, 3}


def test_quality_checks(spark):
    devices, *_ = seed_dimensions(spark)
    rows = readings(spark, [{"device_id": 1}, {"device_id": 77}])
    assert [r["device_id"] for r in quality.orphans(rows, "device_id", devices, "id").collect()] == [77]
    assert quality.duplicates(devices, ["device_type"]).first()["occurrences"] == 5
    flow = quality.layer_flow({"ods": (rows, "reading_time")}, BASE + dt.timedelta(seconds=1)).first()
    assert (flow["row_count"], flow["fresh_rows"], flow["last_time"]) == (2, 0, BASE)
    a = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, n int")
    b = spark.createDataFrame([(1, 6), (2, None), (4, 7)], "k int, n int")
    assert {r["k"]: r["verdict"] for r in quality.reconcile(a, b, ["k"], ["n"]).collect()} == {
        1: "differs", 2: "match", 3: "raw_only", 4: "dws_only"}
