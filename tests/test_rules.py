"""Grading rules at each boundary, with NULLs and zeros."""

import pytest
from helpers import number, readings

from meterdw.functions import grading, tariff


def one(spark, column, **measures):
    return readings(spark, [measures]).select(column.alias("x")).first()["x"]


def scores(spark, rule, rows):
    return [int(r["x"]) for r in readings(spark, rows).select("id", grading.health(rule).alias("x"))
            .orderBy("id").collect()]


def test_health_three_tiers(spark):
    cases = [
        ({}, 95), ({"voltage": "200"}, 95), ({"voltage": "240"}, 95), ({"voltage": "240.01"}, 80),
        ({"voltage": "199.99"}, 80), ({"voltage": "180"}, 80), ({"voltage": "260"}, 80), ({"voltage": "260.01"}, 60),
        ({"voltage": "179.99"}, 60), ({"temperature": "79.99"}, 95), ({"temperature": "80"}, 80),
        ({"temperature": "90"}, 60), ({"power_factor": "0.9"}, 80), ({"power_factor": "0.901"}, 95),
        ({"power_factor": "0.8"}, 60), ({"voltage": None}, 60), ({"temperature": None}, 60),
        ({"power_factor": None}, 60), ({"frequency": None}, 95)]
    assert scores(spark, grading.G1, [c for c, _ in cases]) == [s for _, s in cases]


def test_health_four_tiers(spark):
    cases = [
        ({"power_factor": "0.951"}, 98), ({"power_factor": "0.95"}, 90),
        ({"power_factor": "0.96", "voltage": "210"}, 98), ({"power_factor": "0.96", "voltage": "230"}, 98),
        ({"power_factor": "0.96", "voltage": "209.99"}, 90), ({"power_factor": "0.96", "temperature": "70"}, 90),
        ({"power_factor": "0.96", "frequency": "49.8"}, 98), ({"power_factor": "0.96", "frequency": "49.79"}, 90),
        ({"power_factor": "0.96", "frequency": "50.2"}, 98), ({"power_factor": "0.96", "frequency": "50.5"}, 90),
        ({"frequency": "49.5"}, 90), ({"frequency": "49.49"}, 75), ({"frequency": None}, 75),
        ({"voltage": "261"}, 50), ({"voltage": None}, 50)]
    assert scores(spark, grading.G2, [c for c, _ in cases]) == [s for _, s in cases]


def test_health_other_rules(spark):
    rows = [{}, {"temperature": "70"}, {"temperature": "80"}, {"voltage": None}]
    assert scores(spark, grading.G3, rows) == [95, 85, 70, 70]
    assert scores(spark, grading.G4, [{"power_factor": "0.1"}, {"temperature": "80"}, {"temperature": "90"}]) == [
        95, 80, 60]
    missing = [{}, {"voltage": None}, {"voltage": "0"}, {"temperature": "0"}, {"power_factor": None},
               {"voltage": "300"}]
    assert scores(spark, grading.G5, missing) == [95, 50, 50, 50, 50, 60]


@pytest.mark.parametrize("bands,measure,values", [
    (grading.VS3, "voltage", {"240": "NORMAL", "240.01": "HIGH", "200": "NORMAL", "199.99": "LOW", None: "NORMAL"}),
    (grading.VS5, "voltage", {"250.01": "CRITICAL_HIGH", "250": "HIGH", "180": "LOW", "179.99": "CRITICAL_LOW"}),
    (grading.TS3, "temperature", {"60": "NORMAL", "60.01": "MEDIUM", "80": "MEDIUM", "80.01": "HIGH"}),
    (grading.TS4, "temperature", {"90": "HIGH", "90.01": "CRITICAL_HIGH", None: "NORMAL"}),
    (grading.power_bands("5000", "1000"), "power", {"5000": "NORMAL", "5000.01": "HIGH", "999.99": "LOW",
                                                    "1000": "NORMAL"}),
])
def test_bands(spark, bands, measure, values):
    got = {v: one(spark, grading.band(bands, measure), **{measure: v}) for v in values}
    assert got == values


def test_reading_status(spark):
    assert one(spark, grading.reading_status(), voltage="199.99") == "WARNING"
    assert one(spark, grading.reading_status(), voltage=None, temperature="80.01") == "WARNING"
    assert one(spark, grading.reading_status(), voltage=None, temperature=None) == "NORMAL"
    assert one(spark, grading.reading_status(low_voltage=False), voltage="100") == "NORMAL"
    assert one(spark, grading.reading_status(), voltage="0") == "WARNING"
    assert one(spark, grading.reading_status(zero_is_missing=True), voltage="0") == "NORMAL"


def test_graded_status_equals_reading_status(spark):
    values = [None, "179", "200", "220", "240", "240.01"]
    rows = [{"voltage": v, "temperature": t} for v in values for t in (None, "60", "80", "80.01", "95")]
    graded = grading.grade(readings(spark, rows))
    assert graded.where(grading.graded_status() != grading.reading_status()).count() == 0


def test_four_level_status(spark):
    def status(**measures):
        df = grading.grade(readings(spark, [measures]), grading.GENERATED)
        return df.select(grading.four_level_status().alias("x")).first()["x"]

    assert status(voltage="251") == status(voltage="179") == status(temperature="91") == "CRITICAL"
    assert status(voltage="241") == status(temperature="81") == "WARNING"
    assert status(power_factor="0.85") == "ATTENTION"
    assert status(power_factor="0.96") == "NORMAL"


def test_window_status(spark):
    rows = spark.createDataFrame([(1, 0, number("50")), (0, 0, number("69.99")), (0, 0, number("70"))],
                                 "a int, b int, avg_health_score decimal(5,2)")
    got = [r["s"] for r in rows.selectExpr(grading.window_status_text("a", "b") + " AS s").collect()]
    assert got == ["WARNING", "FAULT", "NORMAL"]


def test_time_of_use_rates(spark):
    rates = spark.range(24).selectExpr(f"CAST({tariff.time_of_use_rate('id')} AS STRING) AS r")
    expected = ["0.4"] * 8 + ["0.8"] * 4 + ["0.6"] * 6 + ["0.8"] * 4 + ["0.6"] * 2
    assert [r["r"] for r in rates.collect()] == expected
