"""Small frames for the tests."""

import datetime as dt
from decimal import Decimal

from meterdw import schemas

BASE = dt.datetime(2024, 5, 1, 8, 0, 0)

PLAIN = {"voltage": "220", "current_val": "15", "power": "3000", "energy": "10", "power_factor": "0.95",
         "frequency": "50", "temperature": "45"}


def number(value):
    return None if value is None else Decimal(value)


def readings(spark, rows):
    """meter_reading rows from dicts; measures not named take unremarkable values."""
    data = []
    for i, row in enumerate(rows):
        measures = {**PLAIN, **row}
        data.append((row.get("id", i), row.get("device_id", 1), row.get("reading_time", BASE),
                     *[number(measures[m]) for m in PLAIN]))
    return spark.createDataFrame(data, schemas.ddl(schemas.METER_READING))


def seed_dimensions(spark):
    """Three substations, six devices (4 in no known substation), three customers; device 3 has two owners."""
    substations = spark.createDataFrame(
        [(1, "North", "A", 110, Decimal(100), "ACTIVE"), (2, "South", "B", 220, Decimal(200), "ACTIVE"),
         (3, "West", "C", 500, Decimal(300), "ACTIVE")], schemas.ddl(schemas.SUBSTATION))
    devices = spark.createDataFrame(
        [(1, "D1", "one", "METER", 1, "NORMAL"), (2, "D2", "two", "METER", 1, "MAINTENANCE"),
         (3, "D3", "three", "BREAKER", 2, "NORMAL"), (4, "D4", "four", "METER", 99, "NORMAL"),
         (5, "D5", "five", "METER", 3, "NORMAL"), (6, "D6", "six", "METER", 2, "DELETED")],
        schemas.ddl(schemas.DEVICE_INFO))
    customers = spark.createDataFrame(
        [(i, f"C{i}", name, kind, *[None] * 5) for i, name, kind in
         ((1, "Ann", "HOME"), (2, "Ben", "HOME"), (3, "Cy", "SHOP"))], schemas.ddl(schemas.CUSTOMER))
    # relation 4 names an unknown customer
    relations = spark.createDataFrame(
        [(1, 1, 3, "OWNER"), (2, 2, 5, "OWNER"), (3, 3, 3, "OWNER"), (4, 77, 6, "OWNER")],
        schemas.ddl(schemas.CUSTOMER_DEVICE))
    return devices, substations, relations, customers
