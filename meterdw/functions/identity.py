"""Names derived from ids, used where a pipeline runs without dimension tables.

The padded codes keep three characters: ids of 1000 and more are cut and collide, as in
the source system. A code is a label, never a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: substations by upper device id, then the name for all others
THREE_SUBSTATIONS = (((2, "上海变电站"), (4, "北京变电站")), "深圳变电站")
TWO_SUBSTATIONS = (((2, "上海变电站"),), "北京变电站")

# fixed values: (name prefix, device type)
SMART_METER = ("智能电表", "SMART_METER")
PLAIN_METER = ("设备", "METER")


def padded_code(prefix: str, number: str) -> str:
    return f"concat('{prefix}', lpad(CAST({number} AS STRING), 3, '0'))"


def substation_text(limits, device_id: str = "device_id") -> str:
    steps, otherwise = limits
    arms = " ".join(f"WHEN {device_id} <= {bound} THEN '{name}'" for bound, name in steps)
    return f"CASE {arms} ELSE '{otherwise}' END"


def substation_for(limits, device_id: str = "device_id") -> Column:
    return F.expr(substation_text(limits, device_id))


def with_generated_names(df: DataFrame, limits=THREE_SUBSTATIONS, kind=SMART_METER) -> DataFrame:
    """Adds device_code, device_name, device_type and substation_name from device_id alone."""
    name_prefix, device_type = kind
    return df.selectExpr(
        "*", f"{padded_code('DEV', 'device_id')} AS device_code",
        f"concat('{name_prefix}', CAST(device_id AS STRING)) AS device_name", f"'{device_type}' AS device_type",
        f"{substation_text(limits)} AS substation_name")


def with_customer_labels(df: DataFrame) -> DataFrame:
    """customer_code and the constant customer_type of the customer summaries."""
    return df.selectExpr("*", f"{padded_code('CUST', 'customer_id')} AS customer_code",
                         "'UNKNOWN' AS customer_type")
