"""Declared column types of the source tables and of the layers."""

from __future__ import annotations



def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


# Types of the measures, also the scale their averages are rounded to (fixed values).
MEASURE_TYPES = {
    "voltage": "decimal(8,2)",
    "current_val": "decimal(8,2)",
    "power": "decimal(10,2)",
    "energy": "decimal(12,2)",
    "power_factor": "decimal(4,3)",
    "frequency": "decimal(6,2)",
    "temperature": "decimal(5,2)",
    "health_score": "decimal(5,2)",
}

# Sums get room for 10^20: a hot substation-hour must not overflow at cluster scale.
SUM_TYPE = "decimal(22,2)"
COST_TYPE = "decimal(22,2)"

SUBSTATION = {
    "id": "int", "name": "string", "location": "string", "voltage_level": "int", "capacity": "decimal(10,2)",
    "status": "string"}
DEVICE_INFO = {
    "id": "int", "device_code": "string", "device_name": "string", "device_type": "string", "substation_id": "int",
    "status": "string"}
CUSTOMER = {
    "id": "int", "customer_code": "string", "customer_name": "string", "customer_type": "string", "address": "string",
    "phone": "string", "email": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
CUSTOMER_DEVICE = {"id": "int", "customer_id": "int", "device_id": "int", "relationship_type": "string"}
METER_READING = {
    "id": "bigint", "device_id": "int", "reading_time": "timestamp_ntz",
    **{name: kind for name, kind in MEASURE_TYPES.items() if name != "health_score"}}
ALARM_INFO = {
    "id": "bigint", "device_id": "int", "alarm_type": "string", "alarm_level": "string",
    "alarm_time": "timestamp_ntz", "status": "string", "resolved_time": "timestamp_ntz"}

ODS = {
    "substation": SUBSTATION,
    "device_info": DEVICE_INFO,
    "grid_customer": CUSTOMER,
    "customer_device": CUSTOMER_DEVICE,
    "meter_reading": METER_READING,
    "alarm_info": ALARM_INFO,
}
