"""The chain of layers against a batch build, delivery by delivery, with restarts; change streams."""

import datetime as dt

import pytest
from helpers import BASE, readings, seed_dimensions
from pyspark.sql import functions as F

from meterdw.operators import changelog, detail, incremental, rollup, serving
from meterdw.plans import queries
from meterdw.plans.chain import Chain
from meterdw.sinks.state import KeyedState
from meterdw.sinks.versions import VersionedTable
from meterdw.sources.tables import Warehouse
from meterdw.streaming import jobs, source


def sorted_rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def build(rows, dims):
    """All layers at once."""
    devices, substations, relations, customers = dims
    owned = detail.owned_device_dim(devices, substations, relations, customers)
    shape = rollup.Dimensions.of(devices, substations, relations, customers)
    parts = serving.window_parts(rows)
    hours = rollup.substation_hour(rollup.with_devices(parts, shape))
    return {"dwd": detail.detail(rows, owned, carry=("id",)),
            "dws_device_hour": rollup.device_hour(rollup.with_devices(parts, shape)),
            "dws_substation_hour": hours,
            "dws_customer_hour": rollup.customer_hour(rollup.with_owners(parts, shape)),
            "monitor": serving.device_monitor(rows, detail.device_dim(devices, substations)),
            "overview": serving.substation_overview(hours)}


def stored(chain):
    return {"dwd": chain.dwd.read(), **{name: table.read() for name, table in chain.hours.items()},
            "monitor": chain.device_monitor(), "overview": chain.overview.read()}


def same(chain, rows, dims):
    want = build(rows, dims)
    return [name for name, got in stored(chain).items() if sorted_rows(got) != sorted_rows(want[name])]


def day_rows(first, devices, day, voltage="220", hours=(0, 1, 1)):
    return [{"id": first + 10 * d + i, "device_id": d, "voltage": voltage,
             "reading_time": BASE + dt.timedelta(days=day, hours=h, minutes=i)} for d in devices for i, h in enumerate(hours)]


@pytest.fixture(scope="module")
def dims(spark):
    return seed_dimensions(spark)


def owned(dims):
    return detail.owned_device_dim(*dims)


class Broken(RuntimeError):
    pass


def break_after(monkeypatch, commits):
    """Lets so many commits of the layers pass, then fails before the next."""
    left = [commits]
    plain = VersionedTable.commit

    def commit(self, build):
        if left[0] == 0:
            raise Broken
        left[0] -= 1
        return plain(self, build)

    monkeypatch.setattr(VersionedTable, "commit", commit)


def test_deliveries_with_breaks_equal_one_build(spark, tmp_path, dims, monkeypatch):
    one = day_rows(0, [1, 2, 3, 4, 5, 6], 0) + day_rows(200, [1, 3], 1, "170")
    # the second delivery is late for day 0, repeats nothing, and brings day 2
    two = day_rows(400, [1, 3, 6], 0, "260", (1, 5)) + day_rows(600, [2, 5], 2)
    root = str(tmp_path / "chain")
    chain = Chain(spark, root)
    chain.set_dimension(owned(dims))
    chain.deliver(readings(spark, one), 0)
    for commits in (1, 3):
        with monkeypatch.context() as patch:
            break_after(patch, commits)
            with pytest.raises(Broken):
                Chain(spark, root).advance()
    chain = Chain(spark, root)
    chain.advance()
    for _ in range(2):
        chain.deliver(readings(spark, two), 1)
    chain.advance()
    assert same(chain, readings(spark, one + two), dims) == []


def test_only_the_days_of_a_delivery_are_read(spark, tmp_path, dims, monkeypatch):
    chain = Chain(spark, str(tmp_path / "chain"))
    chain.set_dimension(owned(dims))
    chain.deliver(readings(spark, [r for d in range(3) for r in day_rows(100 * d, [1, 3], d)]), 0)
    chain.advance()
    read = []
    plain = VersionedTable.frame

    def frame(self, files):
        files = list(files)
        read.extend(files)
        return plain(self, files)

    monkeypatch.setattr(VersionedTable, "frame", frame)
    chain.deliver(readings(spark, day_rows(900, [3], 1)), 1)
    chain.advance_detail()
    chain.advance_parts()
    for name in chain.hours:
        chain.advance_hours(name)
    day = str((BASE + dt.timedelta(days=1)).date())
    indexed = [f for f in read if f.low]
    assert len(indexed) >= 5 and all(f.low[:10] == f.high[:10] == day for f in indexed)


def test_changed_dimensions_revise_the_past(spark, tmp_path, dims):
    devices, substations, relations, customers = dims
    rows = day_rows(0, [1, 2, 3, 4, 5, 6], 0) + day_rows(200, [1, 3, 4], 1)
    chain = Chain(spark, str(tmp_path / "chain"))
    chain.set_dimension(owned(dims))
    chain.deliver(readings(spark, rows), 0)
    chain.advance()
    renamed = substations.withColumn("name", F.when(F.col("id") == 2, "South-East").otherwise(F.col("name")))
    moved = devices.withColumn("substation_id", F.when(F.col("id") == 4, 1).otherwise(F.col("substation_id")))
    handed = relations.withColumn("customer_id", F.when(F.col("id") == 3, 2).otherwise(F.col("customer_id")))
    later = (moved, renamed, handed.where("id <> 2"), customers)
    chain.set_dimension(owned(later))
    late = day_rows(500, [3, 5], 1, "245")
    chain.deliver(readings(spark, late), 1)
    chain.advance()
    before = chain.dim.snapshot().number
    assert chain.set_dimension(owned(later)) == before
    # a device that is gone, then known again
    chain.set_dimension(owned((moved.where("id <> 1"), renamed, handed, customers)))
    chain.advance()
    assert chain.dwd.read().where("device_id = 1").isEmpty()
    chain.set_dimension(owned(later))
    chain.advance()
    assert same(chain, readings(spark, rows + late), later) == []


def test_corrections_and_upkeep(spark, tmp_path, dims):
    rows = day_rows(0, [1, 3, 5], 0) + day_rows(200, [1, 2], 1)
    chain = Chain(spark, str(tmp_path / "chain"))
    chain.set_dimension(owned(dims))
    chain.deliver(readings(spark, rows), 0)
    chain.advance()
    fixed = [{**r, "voltage": "199", "temperature": "90"} if r["id"] in (11, 210, 212, 30) else r for r in rows]
    chain.correct(readings(spark, [r for r in fixed if r["voltage"] == "199"]))
    chain.correct(readings(spark, [{**fixed[0], "voltage": "205"}]))
    fixed[0] = {**fixed[0], "voltage": "205"}
    chain.deliver(readings(spark, day_rows(700, [5], 0)), 1)
    chain.advance()
    now = readings(spark, fixed + day_rows(700, [5], 0))
    assert same(chain, now, dims) == []
    chain.compact()
    chain.vacuum(grace_s=0)
    assert sorted_rows(chain.dwd.read()) == sorted_rows(build(now, dims)["dwd"])
    flow = {r.layer: r for r in chain.flow(str(BASE + dt.timedelta(days=1))).collect()}
    assert flow["ods"].row_count == now.count() and flow["ods"].fresh_rows_at_most == 6
    chain.expire(str(BASE + dt.timedelta(days=1)))
    assert chain.ods.read().count() == 6 and chain.hours["dws_device_hour"].read().count() > 6


# --- change streams ----------------------------------------------------------------------------

CHANGE = "op string, seq bigint, k int, v string, at timestamp_ntz"


def test_partial_rows_merge_in_one_shuffle(spark, tmp_path, dims):
    """New detail rows meet the stored partial rows in one aggregation, null measures and an empty table included."""
    chain = Chain(spark, str(tmp_path / "chain"))
    rows = readings(spark, [{"id": i, "device_id": 1 + i % 3, "voltage": None if i % 4 == 0 else str(200 + i),
                             "reading_time": BASE + dt.timedelta(minutes=i)} for i in range(150)])
    chain.dwd.append(detail.detail(rows, owned(dims), carry=("id",)))
    details = chain.dwd.read()
    empty, want = chain.parts.frame([]), incremental.hour_parts(details)
    chain.parts.append(incremental.parts_after(empty, details.where("id < 80")))
    again = incremental.parts_after(chain.parts.read(), details.where("id >= 80"))
    steps = again._jdf.queryExecution().optimizedPlan().toString()
    assert steps.count("Aggregate [") == 1
    assert sorted_rows(again.select(want.columns)) == sorted_rows(want)


def test_a_large_dimension_is_not_sent_through_the_driver(spark, tmp_path, dims, monkeypatch):
    rows = readings(spark, [{"id": i, "device_id": 1 + i % 3, "reading_time": BASE} for i in range(30)])
    chain = Chain(spark, str(tmp_path / "chain"))
    version = chain.set_dimension(owned(dims))
    small = chain._details(rows, version)
    monkeypatch.setattr("meterdw.plans.chain.BROADCAST_LIMIT", 0)
    large = chain._details(rows, version).select(small.columns)
    plans = [d._jdf.queryExecution().analyzed().toString() for d in (small, large)]
    assert "strategy=broadcast" in plans[0] and "_piece" in plans[1]
    assert sorted_rows(small) == sorted_rows(large) and small.count() > 0


def test_many_changed_keys_are_not_broadcast(spark, tmp_path, monkeypatch):
    """24,000 groups change twice. Their files look small to Spark, which would collect and broadcast any number of keys."""
    rows = readings(spark, []).unionByName(spark.range(24000).selectExpr(
        "id", "CAST(id % 1000 + 1 AS INT) AS device_id", f"TIMESTAMP_NTZ '{BASE.date()}' + make_interval(0, 0, 0, 0, "
        "CAST(id div 1000 AS INT)) AS reading_time", "CAST(220 AS DECIMAL(8,2)) AS voltage"), allowMissingColumns=True)
    dim = spark.range(1, 1001).selectExpr(
        "CAST(id AS INT) AS device_id", "'d' AS device_code", "'d' AS device_name", "'METER' AS device_type",
        "1 AS substation_id", "'s' AS substation_name", "CAST(id AS INT) AS customer_id", "'c' AS customer_name")
    plans, plain = [], VersionedTable.replace

    def replace(self, old, kept, *more, **named):
        plans.append((self.path.rsplit("/", 1)[-1], kept._jdf.queryExecution().executedPlan().toString()))
        return plain(self, old, kept, *more, **named)

    monkeypatch.setattr(VersionedTable, "replace", replace)
    chain = Chain(spark, str(tmp_path / "chain"))
    chain.set_dimension(dim)
    chain.deliver(rows, 0)
    chain.advance(("dws_customer_hour",), states=False)
    assert chain.parts.changed_rows(0, 1) == (24000, 0)
    renamed = dim.withColumn("substation_name", F.lit("t"))
    chain.set_dimension(renamed)
    chain.advance(("dws_customer_hour",), states=False)
    assert chain.dwd.changed_rows(0, chain.dwd.snapshot().number) == (48000, 24000)
    layers = [(name, plan) for name, plan in plans if name in ("dws_parts", "dws_customer_hour")]
    assert [name for name, _ in layers] == ["dws_parts", "dws_customer_hour"] * 2
    assert not [name for name, plan in layers if "BroadcastHashJoin" in plan]
    assert all("SortMergeJoin" in plan for _, plan in layers[1:])
    details = detail.detail(rows, renamed, carry=("id",))
    assert sorted_rows(chain.dwd.read()) == sorted_rows(details)
    want = incremental.SUMMARIES["dws_customer_hour"].make(incremental.hour_parts(details))
    assert sorted_rows(chain.hours["dws_customer_hour"].read()) == sorted_rows(want) and want.count() == 24000


def test_deliveries_are_stored_by_many_tasks(spark, folder):
    """Two micro-batches, however many files a delivery has."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    wh = Warehouse(spark, f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/several")
    Warehouse(spark, folder).events().repartition(4).write.mode("overwrite").parquet(f"{wh.folder}/events.parquet")
    for name in ("supplier", "nation", "region", "customer"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.mode("overwrite").parquet(f"{wh.folder}/{name}.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        chain = queries._chain(wh, hours=(), states=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    inputs = spark.read.parquet(f"{chain.ods.path.removesuffix('/layers/ods')}/in/meter_reading").inputFiles()
    assert len(inputs) > 2 and chain.ods.snapshot().number == 2
    assert sorted_rows(chain.ods.read().select("id")) == sorted_rows(wh.meter_reading().select("id"))


def day(n):
    return BASE + dt.timedelta(days=n)


def run_changes(spark, utc, tmp_path, files, **options):
    for rows in files:
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = source.file_stream(utc, str(tmp_path / "in"), CHANGE, max_files=1)
    jobs.cdc_job(stream, str(tmp_path / "state"), ["k"], "at", str(tmp_path / "cp"), **options).awaitTermination()


def test_late_images_and_deletes_are_refused(spark, utc, tmp_path):
    files = [[("u", 5, 1, "five", day(5)), ("d", 6, 2, "gone", day(6)), ("c", 1, 3, "one", day(1))],
             [("u", 3, 1, "three", day(3)), ("u", 4, 2, "four", day(4)), ("d", 2, 1, "x", day(2))],
             [("u", 7, 3, "seven", day(7)), ("d", 9, 4, "y", day(9))],
             [("u", 5, 1, "five", day(5)), ("u", 8, 4, "eight", day(8))]]
    run_changes(spark, utc, tmp_path, files)
    got = jobs.cdc_state(spark, str(tmp_path / "state"), CHANGE, ["k"])
    everything = spark.createDataFrame([r for rows in files for r in rows], CHANGE)
    assert sorted_rows(got.drop("op")) == sorted_rows(changelog.apply(everything.distinct(), ["k"]))
    assert {(r.k, r.v) for r in got.collect()} == {(1, "five"), (3, "seven")}


def test_deletes_are_forgotten_after_a_while(spark, utc, tmp_path):
    run_changes(spark, utc, tmp_path, [[("d", 1, 1, "x", day(0)), ("d", 2, 2, "x", day(8))], [("u", 3, 3, "v", day(1))]],
                keep_days=5)
    run_changes(spark, utc, tmp_path, [[("u", 4, k, "late", day(10)) for k in range(10, 400)]], keep_days=5)
    state = jobs._change_state(spark, str(tmp_path / "state"), CHANGE, ["k"], "seq")
    assert isinstance(state, KeyedState)
    assert [r.k for r in state.current().where("op = 'd'").collect()] == [2]
