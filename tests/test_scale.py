"""What must hold when dimensions outgrow broadcasting and one key holds a third of the rows."""

import pytest
from helpers import readings, seed_dimensions

from meterdw.functions import grading
from meterdw.operators import detail, joins, rollup, serving
from meterdw.plans.queries import REGISTRY
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 facts, a third of them on key 7; keys 0..99, and NULLs."""
    facts = spark.range(3000).select(
        F.col("id"), F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 100 END").cast(
            "int").alias("k"))
    dim = spark.range(200).select((F.col("id") % 80).cast("int").alias("k"), F.col("id").alias("payload"))
    return facts.persist(), dim.persist()


def test_hot_keys_are_found_and_bounded(skewed):
    facts, _ = skewed
    hot = dict(joins.hot_keys(facts, "k", share=1 / 20))
    assert set(hot) == {7} and 6 <= hot[7] <= 8
    assert len(joins.hot_keys(facts, "k", share=1 / 1000)) <= 1000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("share", [1 / 20, 1 / 500])
def test_split_join_equals_plain_join(skewed, how, share):
    facts, dim = skewed
    plain = facts.join(dim, "k", how)
    split = joins.split_join(facts, dim, "k", how, ["id"], share).select(*plain.columns)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("fact_share", [1, 1 / 3])
def test_hot_dimension_keys_are_cut_too(spark, skewed, fact_share):
    """Key 7 is hot on both sides, key 8 in the dimension only."""
    facts, _ = skewed
    facts = facts if fact_share == 1 else facts.where("k IS NULL OR k <> 7")
    dim = spark.range(900).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN 8 ELSE id % 90 END AS INT) "
                                      "AS k", "id AS payload")
    plain = facts.join(dim, "k")
    split = joins.split_join(facts, dim, "k", "inner", ["id"], 1 / 20, ["payload"]).select(*plain.columns)
    assert "_piece_dim_cuts" in split._jdf.queryExecution().optimizedPlan().toString()
    counts = {tuple(r) for r in split.groupBy("k").count().collect()}
    assert counts == {tuple(r) for r in plain.groupBy("k").count().collect()}
    assert split.distinct().count() == split.count() == plain.count()


@pytest.mark.parametrize("hot", [True, False])
def test_a_dimension_beyond_the_limit_is_not_broadcast(spark, skewed, hot):
    """Whatever size Spark reads off its files; only the table of cuts is sent."""
    facts, dim = skewed
    facts = facts if hot else spark.range(3000).selectExpr("id", "CAST(id AS INT) AS k")
    joined = joins.lookup_join(facts, dim, "k", limit_bytes=0, spread_by=["id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and ("_cuts" in plan) == hot
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" not in line]
    assert joined.count() == facts.join(dim, "k").count()


def test_owners_are_joined_without_broadcast(spark, tmp_path):
    """There may be far more devices, customers and relations than their files suggest."""
    tables = []
    for i, one in enumerate(seed_dimensions(spark)):
        one.write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    dim = detail.owned_device_dim(*tables)
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 5
    assert sorted(map(str, dim.collect())) == sorted(map(str, detail.owned_device_dim(*seed_dimensions(spark)).collect()))


def test_hot_key_reaches_several_tasks(spark, skewed):
    facts, dim = skewed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split = joins.split_join(facts, dim.hint("merge"), "k", "inner", ["id"], 1 / 100)
        spread = split.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spread == 4


def test_only_inner_joins_cut_the_dimension(skewed):
    facts, dim = skewed
    with pytest.raises(ValueError):
        joins.split_join(facts, dim, "k", "left", ["id"], dim_spread_by=["payload"])


def test_detail_is_the_same_without_broadcast(spark, folder, monkeypatch):
    expected = REGISTRY["dwd_device_meter_detail"](spark, folder).collect()
    hours = REGISTRY["dws_customer_hour"](spark, folder).collect()
    for module in (joins, rollup):
        monkeypatch.setattr(module, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", None, None, -1))
    monkeypatch.setattr(joins.sized, "__defaults__", (-1,))
    shuffled = REGISTRY["dwd_device_meter_detail"](spark, folder)
    assert "_piece" in shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, expected))
    assert sorted(map(str, REGISTRY["dws_customer_hour"](spark, folder).collect())) == sorted(map(str, hours))


def test_measured_size_covers_text(spark):
    df = spark.createDataFrame([("x" * 1000, 1), (None, 2)], "s string, n int")
    assert joins.measured_bytes(df) == 1000 + 2 * 48


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(REGISTRY) if not n.startswith(("stream_", "upsert_"))])
def test_plan_shape(spark, folder, name):
    """No cross joins, no Python workers, and no scan of columns the query does not use."""
    plan = _plan(REGISTRY[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan


def test_columns_are_pruned(spark, folder):
    plan = _plan(REGISTRY["readings_per_device"](spark, folder))
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_listings_are_in_order(spark, folder):
    devices = [r.device_id for r in REGISTRY["readings_per_device"](spark, folder).collect()]
    assert len(devices) > 10 and devices == sorted(devices)
    hours = [(r.device_id, r.hour_time) for r in REGISTRY["raw_hourly_device"](spark, folder).collect()]
    assert len(hours) > 10 and hours == sorted(hours)


def test_aggregation_runs_before_any_join(spark):
    """The fact is aggregated bare: no dimension column below the first exchange of the readings."""
    rows = readings(spark, [{"device_id": d} for d in (1, 2, 3)])
    parts = rollup.partials(grading.grade(rows), "1 hour")
    plan = rollup.device_hour(rollup.with_devices(parts, rollup.Dimensions.of(*seed_dimensions(spark))))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner") < text.index("Aggregate [device_id")


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark, folder):
    plan = _plan(REGISTRY["ads_device_realtime"](spark, folder))
    assert plan.count("WindowGroupLimit") == 2


def test_dimension_is_one_row_per_relation(spark):
    dim = detail.owned_device_dim(*seed_dimensions(spark))
    assert dim.count() == 6
    assert serving.latest(dim, ["device_id"], [F.col("customer_id")]).count() == 5


def test_newest_readings_do_not_sort_the_readings(spark, folder):
    from meterdw.sources.tables import Warehouse

    rows = serving.latest_readings(Warehouse(spark, folder).meter_reading())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # below the rank lies the filter by the newest times, which meets the readings themselves
    assert plan.index("WindowGroupLimit") < plan.index("LeftSemi") and "LeftSemi" in plan
    physical = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "HashAggregate" in physical and "SortAggregate" not in physical
    # ties, devices whose readings have no time, readings without a device
    data = [(1, 1, "2024-01-01 00:00:00"), (2, 1, "2024-01-01 00:00:00"), (3, 2, None), (4, 2, None),
            (5, None, "2024-01-01 00:00:00"), (6, 3, None), (7, 3, "2023-01-01 00:00:00")]
    frame = spark.createDataFrame(data, "id bigint, device_id int, reading_time string").withColumn(
        "reading_time", F.col("reading_time").cast("timestamp_ntz"))
    assert sorted(r.id for r in serving.latest_readings(frame).collect()) == [2, 4, 5, 7]


def test_newest_readings_are_planned_without_reading_the_readings(spark, monkeypatch):
    data = [(1, 1, "2024-01-01 00:00:00"), (2, 1, "2024-01-01 00:00:00"), (3, 2, None), (4, 2, None),
            (5, None, "2024-01-01 00:00:00"), (6, 3, None), (7, 3, "2023-01-01 00:00:00"),
            (8, 9, "2024-01-01 00:00:00"), (9, 9, "2024-01-02 00:00:00")]
    frame = spark.createDataFrame(data, "id bigint, device_id int, reading_time string").withColumn(
        "reading_time", F.col("reading_time").cast("timestamp_ntz"))
    # times that cannot be computed: any job that reads them fails
    trap = frame.withColumn("reading_time", F.expr("IF(id > 0, raise_error('read'), reading_time)"))
    known = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,), (77,)], "device_id int")
    rows = serving.latest_readings(trap, known)
    physical = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortAggregate" not in physical and "SortMergeJoin" not in physical
    with pytest.raises(Exception, match="read"):
        rows.collect()
    want = [2, 4, 5, 7, 9]
    assert sorted(r.id for r in serving.latest_readings(frame, known).collect()) == want
    assert serving.latest_readings(frame, known).columns == frame.columns
    assert sorted(r.id for r in serving.latest_readings(frame, known.where("false")).collect()) == want
    monkeypatch.setattr(serving, "BROADCAST_LIMIT", -1)
    assert sorted(r.id for r in serving.latest_readings(frame, known).collect()) == want
