"""Every named query against its SQL statement."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_points
from meterdw.plans.oracle import statements
from meterdw.plans.queries import REGISTRY

# no row of these exists in the smallest data folder
EMPTY = {"monitor_recent_hour", "duplicate_keys"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_a_statement():
    assert set(REGISTRY) == set(statements())
    assert set(REGISTRY) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, folder, name):
    df = REGISTRY[name](spark, folder)
    assert differences(df, con, statements()[name]) == []
    assert name in EMPTY or not df.isEmpty()


@pytest.mark.parametrize("name", ["dws_device_hour", "raw_hourly_device", "alarm_statistics", "dash_window_stats",
                                  "monitor_counts", "stream_tumble_device", "stream_customer_hour_tou"])
def test_session_zone_does_not_matter(spark, con, folder, name):
    elsewhere = spark.newSession()
    elsewhere.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    assert differences(REGISTRY[name](elsewhere, folder), con, statements()[name]) == []


@pytest.mark.parametrize("name, keys", [("dash_status_summary", ["device_count", "status"]),
                                        ("device_hour_listing", ["device_id", "stat_date", "stat_hour"])])
def test_order(spark, con, folder, name, keys):
    mine = [tuple(r) for r in REGISTRY[name](spark, folder).select(*keys).collect()]
    rel = con.sql(statements()[name])
    at = [rel.columns.index(k) for k in keys]
    assert mine == [tuple(row[i] for i in at) for row in rel.fetchall()]
