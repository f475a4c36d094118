"""Reconciliation by digests: only ranges that differ are joined row by row."""

import datetime as dt

from meterdw.operators import quality

KEYS, MEASURES = ["k", "day"], ["v"]


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, day date, v int, other string")


def test_one_changed_row_concerns_one_range(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    rows = [(k, d, k, "x") for d in days for k in range(200)] + [(None, days[0], None, "n"), (7, None, 1, "n")]
    a = table(spark, rows)
    assert quality.differing_ranges(a, a.repartition(7).withColumnRenamed("other", "y"), KEYS, MEASURES, "day").isEmpty()
    changed = [(k, d, v + 1 if (k, d) == (17, days[2]) else v, o) for k, d, v, o in rows]
    b = table(spark, changed)
    assert [r.day for r in quality.differing_ranges(a, b, KEYS, MEASURES, "day").collect()] == [days[2]]
    found = quality.reconcile_ranges(a, b, KEYS, MEASURES, "day").collect()
    assert [(r.k, r.day, r.raw_v, r.dws_v, r.verdict) for r in found] == [(17, days[2], 17, 18, "differs")]


def test_missing_and_swapped_rows_are_found(spark):
    day = dt.date(2024, 1, 1)
    a = table(spark, [(1, day, 5, ""), (2, day, 6, ""), (3, day, 7, "")])
    b = table(spark, [(1, day, 6, ""), (2, day, 5, ""), (4, day, 7, "")])
    found = {r.k: r.verdict for r in quality.reconcile_ranges(a, b, KEYS, MEASURES, "day", ranges=1).collect()}
    assert found == {1: "differs", 2: "differs", 3: "raw_only", 4: "dws_only"}
    none = table(spark, [])
    assert quality.reconcile_ranges(none, none, KEYS, MEASURES, "day").isEmpty()
    assert quality.reconcile_ranges(a, none, KEYS, MEASURES, "day").count() == 3
