"""File and JDBC sinks, batch pipelines."""

import datetime as dt

import duckdb
import pytest
from helpers import BASE, readings

from meterdw import schemas
from meterdw.operators import detail
from meterdw.plans import pipelines, queries
from meterdw.plans.queries import REGISTRY
from meterdw.sinks import files, publish
from meterdw.sinks import jdbc as jdbc_sink
from meterdw.sources import jdbc
from meterdw.sources.tables import StoredTables, Warehouse
from meterdw.streaming import jobs, source
from pyspark.sql import functions as F


def test_append_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    files.append_rows(df, path, ("day",))
    files.append_rows(df, path, ("day",))
    assert spark.read.parquet(path).count() == 4


def test_upsert_replay_and_compaction(spark, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "compacted")
    first = readings(spark, [{"id": 1}, {"id": 2, "device_id": 2}])
    later = readings(spark, [{"id": 3, "reading_time": BASE + dt.timedelta(minutes=1)}])
    files.upsert_batch(first, 0, path)
    for _ in range(3):
        files.upsert_batch(later, 1, path)
    assert files.read_batches(spark, path).count() == 3

    def current(where):
        return sorted(r["id"] for r in files.read_latest(spark, where, ["device_id"], [F.desc("reading_time")])
                      .collect())

    assert current(path) == [2, 3]
    files.compact(spark, path, target, ["device_id"], [F.desc("reading_time")])
    assert files.read_batches(spark, target).count() == 2
    files.upsert_batch(readings(spark, [{"id": 9, "reading_time": BASE + dt.timedelta(minutes=2)}]), 2, target)
    assert current(target) == [2, 9]


def test_last_arrival_or_newest_event_wins(spark, tmp_path):
    """The keyed monitor takes the last arrival; with an ordering, the newest event time."""
    path = str(tmp_path / "monitor")
    newer = readings(spark, [{"id": 1, "reading_time": BASE + dt.timedelta(minutes=5)}])
    files.upsert_batch(detail.four_level_monitor(detail.generated_detail(newer)), 0, path)
    older = readings(spark, [{"id": 2, "voltage": "300"}])
    files.upsert_batch(detail.four_level_monitor(detail.generated_detail(older)), 1, path)
    assert files.read_latest(spark, path, ["device_id"]).first()["status"] == "CRITICAL"
    newest = files.read_latest(spark, path, ["device_id"], [F.desc("last_update_time")]).first()
    assert newest["last_update_time"] == BASE + dt.timedelta(minutes=5)


def test_full_refresh_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    codes = spark.createDataFrame([("a",), ("b",)], "code string")
    files.full_refresh(codes, path, unique=("code",))
    with pytest.raises(files.DuplicateKeys):
        files.full_refresh(codes.unionByName(codes), path, unique=("code",))
    assert files.read_published(spark, path).count() == 2
    files.full_refresh(codes.limit(1), path, unique=("code",))
    assert files.read_published(spark, path).count() == 1


def test_batch_build(spark, folder, tmp_path):
    wh = Warehouse(spark, folder)
    paths = pipelines.build_batch(wh, str(tmp_path))
    counts = {name: files.read_published(spark, path).count() for name, path in paths.items()}
    assert counts["dwd_detail"] == REGISTRY["dwd_device_meter_detail"](spark, folder).count() and all(counts.values())
    states = pipelines.refresh_states(wh, str(tmp_path), newest=100)
    assert files.read_published(spark, states["substation_states"]).count() > 0


def test_jdbc_options():
    """Options only: no database runs in the tests."""
    options = jdbc.scan_options("jdbc:x", "meter_reading", "id", 1, 10_000, 4)
    assert {k: options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "10000", "numPartitions": "4"}
    assert "partitionColumn" not in jdbc.scan_options("jdbc:x", "device_info")
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "t", "id", 1)
    flush = jdbc_sink.FLUSH["device_window_summary"]
    assert jdbc_sink.write_options("jdbc:x", "t", flush)["batchsize"] == "20" and flush.interval == "3 seconds"


def test_jdbc_bounds_drop_rows(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    assert jdbc.within_bounds(df, "k", 5, 10).count() == 6


def test_stored_source_tables(spark, folder, tmp_path):
    derived = Warehouse(spark, folder)
    for name in schemas.ODS:
        # further columns, another order and wider types, as a real table may have them
        rows = getattr(derived, name)()
        rows.select(F.lit("x").alias("extra"), *reversed(rows.columns)).withColumn(
            "id", F.col("id").cast("decimal(20,0)")).write.parquet(f"{tmp_path}/{name}.parquet")
        rows.createOrReplaceTempView(name)
    for stored in (StoredTables(spark, str(tmp_path), ".parquet"), StoredTables(spark)):
        for name, columns in schemas.ODS.items():
            rows = getattr(stored, name)()
            assert dict(rows.dtypes).keys() == columns.keys()
            assert sorted(map(str, rows.collect())) == sorted(map(str, getattr(derived, name)().collect()))
        for query in (queries.dws_device_hour, queries.ads_device_realtime, queries.device_5min_recent):
            assert sorted(map(str, query(stored).collect())) == sorted(map(str, query(derived).collect()))
    for name in schemas.ODS:
        spark.catalog.dropTempView(name)


COLUMNS = {"device_id": "int", "power": "decimal(10,2)", "id": "bigint"}


class Failing(publish.FolderTarget):
    """Breaks off between the rows and the mark."""

    def append(self, rows, table):
        if table.endswith("_marks"):
            raise ConnectionError(table)
        super().append(rows, table)


def test_batches_are_published_once(spark, tmp_path):
    target = publish.FolderTarget(str(tmp_path))
    table = publish.Published(target, "monitor", COLUMNS, ("device_id",))
    assert table.visible(spark).count() == 0
    first = readings(spark, [{"id": 1}, {"id": 2, "device_id": 2}])
    broken = publish.Published(Failing(str(tmp_path)), "monitor", COLUMNS, ("device_id",))
    for _ in range(2):
        with pytest.raises(ConnectionError):
            broken.handler()(first, 0)
    assert table.visible(spark).count() == 0
    assert table.publish(first, 0) and not table.publish(first, 0)
    later = readings(spark, [{"id": 3, "device_id": 2, "power": "7"}])
    with pytest.raises(ConnectionError):
        broken.publish(later, 1)
    assert sorted(r.id for r in table.visible(spark).collect()) == [1, 2]
    assert table.publish(later, 1) and table.publish(later.limit(0), 2) and not table.publish(later, 2)
    assert sorted(r.id for r in table.visible(spark).collect()) == [1, 3]
    rows = target.read(spark, "monitor_rows", "device_id int, writer string, batch_id long, attempt string")
    assert rows.count() == 2 * 3 + 2 * 1

    con = duckdb.connect()
    for part in ("rows", "marks"):
        con.execute(f"CREATE TABLE monitor_{part} AS SELECT * FROM read_parquet('{tmp_path}/monitor_{part}/*.parquet')")
    seen = con.sql(table.visible_sql()).fetchall()
    assert sorted(seen) == sorted(map(tuple, table.visible(spark).collect()))
    con.execute(table.leftovers_sql())
    assert con.sql("SELECT COUNT(*) FROM monitor_rows").fetchall() == [(3,)]
    assert sorted(con.sql(table.visible_sql()).fetchall()) == sorted(seen)


def test_two_attempts_with_marks_count_once_and_whole_batches_replace(spark, tmp_path):
    target = publish.FolderTarget(str(tmp_path))
    table = publish.Published(target, "overview", COLUMNS)

    class Unaware(publish.Published):
        """A second driver that did not see the first one's mark."""

        def is_marked(self, spark, batch_id, writer=""):
            return False

    rows = readings(spark, [{"id": 1}, {"id": 2}])
    table.publish(rows, 4, "a")
    Unaware(target, "overview", COLUMNS).publish(rows, 4, "a")
    assert table.visible(spark).count() == 2
    table.publish(readings(spark, [{"id": 5}]), 4, "b")
    table.publish(readings(spark, [{"id": 6}]), 5, "a", whole=True)
    table.publish(readings(spark, [{"id": 7}]), 6, "a")
    assert sorted(r.id for r in table.visible(spark).collect()) == [5, 6, 7]


def test_stream_published_once(utc_feed, spark, tmp_path):
    """A stream that loses its checkpoint sends its batches again: nothing is doubled."""
    table = publish.Published(publish.FolderTarget(str(tmp_path / "out")), "raw", COLUMNS)
    for run in range(2):
        jobs.start(utc_feed, table.handler("raw"), f"{tmp_path}/checkpoint{run}").awaitTermination()
    assert table.visible(spark).count() == 4


@pytest.fixture
def utc_feed(utc, tmp_path):
    for part in range(2):
        readings(utc, [{"id": 2 * part}, {"id": 2 * part + 1}]).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/feed")
    return source.file_stream(utc, f"{tmp_path}/feed", schemas.ddl(schemas.METER_READING), max_files=1)
