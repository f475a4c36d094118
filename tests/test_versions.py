"""Versioned tables: pinned readers, replays, compaction and retention beside a writer, opened files."""

import datetime as dt
import threading
from collections import Counter

import pytest
from helpers import BASE, readings
from pyspark.sql import functions as F

from meterdw import schemas
from meterdw.operators import changelog
from meterdw.plans.queries import REGISTRY
from meterdw.sinks import versions
from meterdw.sinks.state import KeyedState
from meterdw.sinks.versions import Conflict, KeyedLog, Record, VersionedTable
from meterdw.sources.tables import Warehouse

READING = schemas.ddl(schemas.METER_READING)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def opened(df):
    return len(df.inputFiles())


def days(spark, numbers, first=0, per_day=3):
    return readings(spark, [{"id": first + 10 * n + i, "reading_time": BASE + dt.timedelta(days=n, hours=i)}
                            for n in numbers for i in range(per_day)])


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), READING, "reading_time")


def test_a_version_keeps_its_rows(spark, table):
    assert table.read().isEmpty() and table.snapshot().number == 0
    one = table.append(days(spark, [0]))
    two = table.append(days(spark, [1]))
    table.replace(list(table.snapshot().files.values()), days(spark, [5]))
    assert ids(table.read(one)) == [0, 1, 2] and ids(table.read(two)) == [0, 1, 2, 10, 11, 12]
    assert ids(table.read()) == [50, 51, 52] and table.read(0).isEmpty()
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)


def test_replayed_batches_change_nothing(spark, table):
    for _ in range(2):
        table.append(days(spark, [0]), "a", 0)
    table.append(days(spark, [1]), "b", 0)
    table.append(days(spark, [2]), "a", 1)
    table.append(days(spark, [3]), "a", 0)
    assert len(ids(table.read())) == 9 and table.snapshot().batches == {"a": 1, "b": 0}
    table.append(days(spark, []), "a", 2)
    assert table.snapshot().number == 4 and len(ids(table.read())) == 9


def test_only_files_that_can_hold_the_times_are_opened(spark, table):
    table.append(days(spark, range(10)))
    since, until = str(BASE + dt.timedelta(days=4, hours=1)), str(BASE + dt.timedelta(days=5))
    rows = table.read(since=since, until=until)
    assert ids(rows) == [41, 42, 50] and opened(rows) == 2 and opened(table.read()) == 10
    assert table.newest() == str(BASE + dt.timedelta(days=9, hours=2))


def test_retention_reads_files_across_the_boundary_only(spark, table):
    table.append(days(spark, range(6)).unionByName(readings(spark, [{"id": 99, "reading_time": None}])))
    boundary = str(BASE + dt.timedelta(days=3, hours=1))
    kept = changelog.retain(table.read(), "reading_time", F.lit(boundary).cast("timestamp_ntz"))
    want = ids(kept)
    assert table.expire(boundary) == {"dropped": 3, "rewritten": 1}
    assert ids(table.read()) == want == [31, 32, 40, 41, 42, 50, 51, 52, 99]
    assert table.expire(boundary) == {"dropped": 0, "rewritten": 0}


def test_changes_are_told_once(spark, table):
    table.append(days(spark, [0]))
    first = table.snapshot().number
    table.append(days(spark, [1]))
    old = list(table.snapshot().files.values())
    stored = table.frame(old)
    table.replace(old, stored.where("id <> 1"), stored.where("id = 1").withColumn("voltage", F.lit(1)), stored.where("id = 1"))
    table.compact()
    signed = Counter((r.id, r._sign) for r in table.changes(first).collect())
    assert signed == {(10, 1): 1, (11, 1): 1, (12, 1): 1, (1, 1): 1, (1, -1): 1}
    assert table.changes(table.snapshot().number).isEmpty()
    assert table.changed_days(first, first + 2) == ([str(BASE.date()), str((BASE + dt.timedelta(days=1)).date())],
                                                    [str(BASE.date())])


def test_compaction_leaves_one_file_a_day(spark, table):
    for first in (0, 100, 200):
        table.append(days(spark, [0, 1], first))
    table.append(days(spark, [2]))
    before = ids(table.read())
    assert opened(table.read()) == 7
    table.compact()
    assert ids(table.read()) == before and opened(table.read()) == 3
    assert table.compact() == table.snapshot().number


def test_old_records_go_and_versions_stay_readable(spark, table, monkeypatch):
    monkeypatch.setattr(versions, "WHOLE_EVERY", 4)
    for n in range(10):
        table.append(days(spark, [n]))
    table.compact()
    assert table.vacuum(7, grace_s=0) == 0 and table.numbers()[0] == 4
    assert len(ids(table.read(7))) == 21 and len(ids(table.read())) == 30
    with pytest.raises(ValueError, match="gone"):
        table.changes(2)
    table.replace(list(table.snapshot().files.values()), days(spark, [0]))
    assert table.vacuum(table.snapshot().number, grace_s=86400) == 0
    assert table.vacuum(table.snapshot().number, grace_s=0) == 10
    assert ids(table.read()) == [0, 1, 2]


def test_a_taken_number_is_not_written_twice(spark, table):
    table.append(days(spark, [0]))
    added = table.store(days(spark, [1]))
    calls = []

    def build(now):
        if not calls:
            calls.append(now.number)
            VersionedTable(spark, table.path, READING, "reading_time").append(days(spark, [2]))
        calls.append(now.number)
        return Record("append", added, plus=added)

    assert table.commit(build) == 3 and calls == [1, 1, 2]
    assert ids(table.read()) == [0, 1, 2, 10, 11, 12, 20, 21, 22]


def test_files_that_left_are_not_replaced(spark, table):
    table.append(days(spark, [0]))
    old = list(table.snapshot().files.values())
    table.replace(old, days(spark, [1]))
    with pytest.raises(Conflict):
        table.replace(old, days(spark, [2]))
    assert ids(table.read()) == [10, 11, 12]


def test_a_writer_runs_across_compactions_and_a_removal(spark, tmp_path):
    """Batch n holds keys 0 to 9 with voltage n; whoever reads sees all ten keys and never an older value again."""
    def log():
        return KeyedLog(spark, str(tmp_path / "log"), "k int, v int", ["k"])

    stop, seen, failures = threading.Event(), [], []

    def read():
        try:
            while not stop.is_set():
                rows = log().current().collect()
                if rows:
                    seen.append((len(rows), min(r.v for r in rows)))
        except Exception as error:  # noqa: BLE001 - shown by the assertion below
            failures.append(error)

    log().upsert(spark.range(10).selectExpr("CAST(id AS INT) k", "0 v"), 0)
    reader = threading.Thread(target=read)
    reader.start()
    writer = log()
    for n in range(1, 9):
        writer.upsert(spark.range(10).selectExpr("CAST(id AS INT) k", f"{n} v"), n)
        if n in (3, 6):
            log().compact()
        if n == 7:
            log().vacuum(log().snapshot().number - 2, grace_s=0)
    stop.set()
    reader.join()
    assert not failures and all(count == 10 for count, _ in seen)
    assert [v for _, v in seen] == sorted(v for _, v in seen) and seen
    assert {(r.k, r.v) for r in log().current().collect()} == {(k, 8) for k in range(10)}
    log().compact()
    assert log().read().count() == 10


# --- keyed state ---------------------------------------------------------------------------------

def test_a_batch_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), "k int, at int, v string", ["k"], [F.desc("at")], buckets=8)
    state.merge(spark.range(100).selectExpr("CAST(id AS INT) k", "1 at", "'a' v"), "w", 0)
    before = set(state.snapshot().files)
    for _ in range(2):
        state.merge(spark.createDataFrame([(5, 2, "new"), (5, 0, "old"), (6, 0, "late")], "k int, at int, v string"), "w", 1)
    now = set(state.snapshot().files)
    assert state.snapshot().number == 2 and len(before - now) == len(now - before) <= 2 and before & now
    rows = {r.k: r.v for r in state.current().collect()}
    assert len(rows) == 100 and rows[5] == "new" and rows[6] == "a"
    gone = spark.createDataFrame([(5,), (7,)], "k int")
    state.merge(spark.createDataFrame([(7, 0, "again")], "k int, at int, v string"), instead=gone)
    rows = {r.k: r.v for r in state.current().collect()}
    assert len(rows) == 99 and rows[7] == "again" and 5 not in rows


def test_files_of_the_whole_table(spark, folder, tmp_path):
    rows = Warehouse(spark, folder).meter_reading()
    table = VersionedTable(spark, str(tmp_path / "r"), READING, "reading_time")
    table.append(rows)
    assert table.read().exceptAll(rows).isEmpty() and table.read().count() == rows.count()
    assert table.newest()[:19] == str(rows.agg(F.max("reading_time")).first()[0])[:19]
    assert "upsert_latest_by_key" in REGISTRY
