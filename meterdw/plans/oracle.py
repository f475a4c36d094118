"""The same queries as plain SQL over the given tables, run in DuckDB to check results.

They are written the direct way (join everything, then group), independently of how the
DataFrame side stages its work. Averages use integer arithmetic: DuckDB averages a decimal
as a double, which loses exact halves.
"""

from __future__ import annotations

from meterdw.schemas import COST_TYPE, MEASURE_TYPES, SUM_TYPE

D2 = "CAST(0.01 AS DECIMAL(3,2))"
D3 = "CAST(0.001 AS DECIMAL(4,3))"
JSON_K = "json_extract_string(props, '$.k')"

SOURCES = {
    "meter_reading": f"""
SELECT event_id AS id, CAST(user_id + 1 AS INT) AS device_id, ts AS reading_time,
  CASE WHEN event_id % 97 = 0 THEN NULL
       ELSE CAST((17000 + 50 * ((event_id * 7919) % 201)) * {D2} AS DECIMAL(8,2)) END AS voltage,
  CAST((800 + 10 * ((event_id * 104729) % 421)) * {D2} AS DECIMAL(8,2)) AS current_val,
  CAST((50000 + 10000 * ((event_id * 15485863) % 61)) * {D2} AS DECIMAL(10,2)) AS power,
  CAST(value AS DECIMAL(12,2)) AS energy,
  CAST((700 + 5 * ((event_id * 31) % 61)) * {D3} AS DECIMAL(4,3)) AS power_factor,
  CAST((4900 + 10 * ((event_id * 17) % 21)) * {D2} AS DECIMAL(6,2)) AS frequency,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(CAST({JSON_K} AS INT) + 20 AS DECIMAL(5,2)) END AS temperature
FROM events""",
    "device_info": """
SELECT CAST(s_suppkey + 1 AS INT) AS id, 'DEV' || LPAD(CAST(s_suppkey + 1 AS VARCHAR), 3, '0') AS device_code,
  s_name AS device_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'TRANSFORMER' WHEN 1 THEN 'BREAKER' ELSE 'METER' END AS device_type,
  CAST(CASE WHEN s_suppkey % 9 = 4 THEN 99 ELSE s_nationkey + 1 END AS INT) AS substation_id,
  CASE WHEN s_suppkey % 11 = 0 THEN 'MAINTENANCE' WHEN s_suppkey % 13 = 0 THEN 'DELETED' ELSE 'NORMAL' END AS status
FROM supplier""",
    "substation": """
SELECT CAST(n_nationkey + 1 AS INT) AS id, n_name AS name, r_name AS location,
  CASE n_regionkey % 3 WHEN 0 THEN 110 WHEN 1 THEN 220 ELSE 500 END AS voltage_level,
  CAST(100 * (n_nationkey + 1) AS DECIMAL(10,2)) AS capacity, 'ACTIVE' AS status
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "grid_customer": """
SELECT CAST(c_custkey + 1 AS INT) AS id, 'CUST' || LPAD(CAST(c_custkey + 1 AS VARCHAR), 3, '0') AS customer_code,
  c_name AS customer_name, c_mktsegment AS customer_type, 'No. ' || CAST(c_custkey % 500 + 1 AS VARCHAR) AS address,
  '13' || LPAD(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
  CASE WHEN c_custkey % 7 <> 0 THEN 'customer' || CAST(c_custkey + 1 AS VARCHAR) || '@example.org' END AS email,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey % 100000 AS INT)) AS created_at,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(c_custkey % 100000 AS INT)) AS updated_at FROM customer""",
    "customer_device": """
SELECT CAST(c_custkey * 2 + 1 AS INT) AS id, CAST(c_custkey + 1 AS INT) AS customer_id,
  CAST((c_custkey - c_custkey % 20) / 20 + 1 AS INT) AS device_id, 'OWNER' AS relationship_type
FROM customer WHERE c_custkey % 20 = 0
UNION ALL
SELECT CAST(c_custkey * 2 + 2 AS INT), CAST(c_custkey + 1 AS INT),
  CAST(CASE WHEN c_custkey % 90 = 31 THEN 2000000000 ELSE (c_custkey - c_custkey % 30) / 30 + 1 END AS INT), 'OWNER'
FROM customer WHERE c_custkey % 30 = 1""",
    "alarm_info": """
SELECT event_id AS id, CAST(user_id + 1 AS INT) AS device_id,
  CASE event_id % 6 WHEN 0 THEN 'OVERVOLTAGE' WHEN 1 THEN 'UNDERVOLTAGE' WHEN 2 THEN 'OVERCURRENT'
    WHEN 3 THEN 'OVERTEMPERATURE' WHEN 4 THEN 'POWER_FAILURE' ELSE 'COMMUNICATION_FAULT' END AS alarm_type,
  CASE event_id % 4 WHEN 0 THEN 'INFO' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'ERROR' ELSE 'CRITICAL' END AS alarm_level,
  ts AS alarm_time, CASE WHEN event_id % 3 = 0 THEN 'RESOLVED' ELSE 'ACTIVE' END AS status,
  CASE WHEN event_id % 3 = 0 THEN ts + to_minutes(CAST(event_id % 120 + 1 AS INT)) END AS resolved_time
FROM events WHERE event_type = 'error'""",
    "changelog": """
SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, event_id AS seq,
  user_id AS account_id, CAST(value AS DECIMAL(12,2)) AS balance, ts AS changed_at FROM events""",
}


# --- rules -----------------------------------------------------------------------------------

def _score(cases: str) -> str:
    return f"CAST(CASE {cases} END AS DECIMAL(5,2))"


H1 = _score("WHEN voltage BETWEEN 200 AND 240 AND temperature < 80 AND power_factor > 0.9 THEN 95 "
            "WHEN voltage BETWEEN 180 AND 260 AND temperature < 90 AND power_factor > 0.8 THEN 80 ELSE 60")
H2 = _score("WHEN voltage BETWEEN 210 AND 230 AND temperature < 70 AND power_factor > 0.95 "
            "AND frequency BETWEEN 49.8 AND 50.2 THEN 98 "
            "WHEN voltage BETWEEN 200 AND 240 AND temperature < 80 AND power_factor > 0.9 "
            "AND frequency BETWEEN 49.5 AND 50.5 THEN 90 "
            "WHEN voltage BETWEEN 180 AND 260 AND temperature < 90 AND power_factor > 0.8 THEN 75 ELSE 50")
H3 = _score("WHEN voltage BETWEEN 210 AND 230 AND temperature < 70 THEN 95 "
            "WHEN voltage BETWEEN 200 AND 240 AND temperature < 80 THEN 85 ELSE 70")
H4 = _score("WHEN voltage BETWEEN 200 AND 240 AND temperature < 80 THEN 95 "
            "WHEN voltage BETWEEN 180 AND 260 AND temperature < 90 THEN 80 ELSE 60")
H5 = _score("WHEN coalesce(voltage, 0) = 0 OR coalesce(temperature, 0) = 0 OR coalesce(power_factor, 0) = 0 THEN 50 "
            "WHEN voltage BETWEEN 200 AND 240 AND temperature < 80 AND power_factor > 0.9 THEN 95 "
            "WHEN voltage BETWEEN 180 AND 260 AND temperature < 90 AND power_factor > 0.8 THEN 80 ELSE 60")
VOLT3 = "CASE WHEN voltage > 240 THEN 'HIGH' WHEN voltage < 200 THEN 'LOW' ELSE 'NORMAL' END"
VOLT5 = ("CASE WHEN voltage > 250 THEN 'CRITICAL_HIGH' WHEN voltage > 240 THEN 'HIGH' "
         "WHEN voltage < 180 THEN 'CRITICAL_LOW' WHEN voltage < 200 THEN 'LOW' ELSE 'NORMAL' END")
TEMP3 = "CASE WHEN temperature > 80 THEN 'HIGH' WHEN temperature > 60 THEN 'MEDIUM' ELSE 'NORMAL' END"
TEMP4 = ("CASE WHEN temperature > 90 THEN 'CRITICAL_HIGH' WHEN temperature > 80 THEN 'HIGH' "
         "WHEN temperature > 60 THEN 'MEDIUM' ELSE 'NORMAL' END")


def _power(high: int, low: int) -> str:
    return f"CASE WHEN power > {high} THEN 'HIGH' WHEN power < {low} THEN 'LOW' ELSE 'NORMAL' END"


RAW_STATUS = "CASE WHEN voltage > 240 OR voltage < 200 OR temperature > 80 THEN 'WARNING' ELSE 'NORMAL' END"
GRADED_STATUS = ("CASE WHEN voltage_status <> 'NORMAL' OR temperature_status = 'HIGH' "
                 "THEN 'WARNING' ELSE 'NORMAL' END")
FOUR_STATUS = ("CASE WHEN voltage_status IN ('CRITICAL_HIGH', 'CRITICAL_LOW') "
               "OR temperature_status = 'CRITICAL_HIGH' THEN 'CRITICAL' "
               "WHEN voltage_status <> 'NORMAL' OR temperature_status = 'HIGH' THEN 'WARNING' "
               "WHEN health_score < 80 THEN 'ATTENTION' ELSE 'NORMAL' END")
CODE = "'DEV' || LPAD(CAST(device_id AS VARCHAR), 3, '0')"
STATION3 = "CASE WHEN device_id <= 2 THEN '上海变电站' WHEN device_id <= 4 THEN '北京变电站' ELSE '深圳变电站' END"
STATION2 = "CASE WHEN device_id <= 2 THEN '上海变电站' ELSE '北京变电站' END"

SOURCES |= {
    "device": "SELECT d.id AS device_id, device_code, device_name, device_type, s.id AS substation_id, "
              "s.name AS substation_name FROM device_info d JOIN substation s ON d.substation_id = s.id",
    "dwd": f"""
SELECT d.device_id, device_code, device_name, device_type, substation_id, substation_name,
  coalesce(c.id, 0) AS customer_id, coalesce(c.customer_name, 'Unknown') AS customer_name, reading_time,
  voltage, current_val, power, energy, power_factor, frequency, temperature,
  {H1} AS health_score, {VOLT3} AS voltage_status, {TEMP3} AS temperature_status, {_power(5000, 1000)} AS power_status
FROM meter_reading m JOIN device d ON m.device_id = d.device_id
LEFT JOIN customer_device cd ON d.device_id = cd.device_id LEFT JOIN grid_customer c ON cd.customer_id = c.id""",
    "gen": f"""
SELECT device_id, {CODE} AS device_code, '智能电表' || CAST(device_id AS VARCHAR) AS device_name,
  'SMART_METER' AS device_type, {STATION3} AS substation_name, reading_time,
  voltage, current_val, power, energy, power_factor, frequency, temperature,
  {H2} AS health_score, {VOLT5} AS voltage_status, {TEMP4} AS temperature_status, {_power(4500, 2000)} AS power_status
FROM meter_reading""",
    "simple": f"""
SELECT device_id, {CODE} AS device_code, {STATION2} AS substation_name, reading_time, voltage, temperature,
  {H1} AS health_score, {RAW_STATUS} AS status FROM meter_reading""",
    "latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY device_id ORDER BY reading_time DESC, id DESC) AS rn FROM meter_reading)
WHERE rn = 1""",
    "clock": "SELECT MAX(reading_time) AS newest FROM meter_reading",
}


# --- aggregates --------------------------------------------------------------------------------

def avg_ratio(total: str, count: str, to_type: str, scale: int = 2) -> str:
    """total / count rounded half-up, for a non-negative total with `scale` digits."""
    one = {1: "CAST(0.1 AS DECIMAL(2,1))", 2: D2, 3: D3}[scale]
    ticks = f"CAST(({total}) * {10 ** scale} AS HUGEINT)"
    return (f"CAST(CAST((2 * {ticks} + ({count})) // NULLIF(2 * ({count}), 0) AS DECIMAL(18,0)) * {one} "
            f"AS {to_type.upper()})")


def avg(column: str, alias: str | None = None, like: str | None = None) -> str:
    scale = 3 if (like or column) == "power_factor" else 2
    to_type = MEASURE_TYPES[like or column]
    return f"{avg_ratio(f'SUM({column})', f'COUNT({column})', to_type, scale)} AS {alias or 'avg_' + column}"


def total(column: str, alias: str) -> str:
    return f"CAST(SUM({column}) AS {SUM_TYPE.upper()}) AS {alias}"


def count_if(condition: str, alias: str, kind: str = "BIGINT") -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS {kind}) AS {alias}"


def distinct(condition: str, alias: str) -> str:
    return f"CAST(COUNT(DISTINCT CASE WHEN {condition} THEN device_id END) AS INT) AS {alias}"


ELECTRIC = ", ".join([
    avg("voltage"), "MAX(voltage) AS max_voltage", "MIN(voltage) AS min_voltage", avg("current_val", "avg_current"),
    "MAX(current_val) AS max_current", avg("power"), "MAX(power) AS max_power", total("energy", "total_energy")])
FULL = ", ".join([
    "COUNT(*) AS reading_count", ELECTRIC, avg("power_factor"), avg("frequency"), avg("temperature"),
    "MAX(temperature) AS max_temperature", "MIN(temperature) AS min_temperature", avg("health_score")])
BAD = "voltage_status <> 'NORMAL' OR temperature_status IN ('HIGH', 'CRITICAL_HIGH')"
GOOD = "voltage_status = 'NORMAL' AND temperature_status IN ('NORMAL', 'MEDIUM')"
DAY_HOUR = "CAST(reading_time AS DATE) AS stat_date, CAST(hour(reading_time) AS INT) AS stat_hour"
DEVICE = "device_id, device_code, device_name, device_type"


def bucket(width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', reading_time)"


def window(width: str) -> str:
    return f"{bucket(width)} AS window_start, {bucket(width)} + INTERVAL '{width}' AS window_end"


RATE = ("CASE WHEN stat_hour BETWEEN 8 AND 11 OR stat_hour BETWEEN 18 AND 21 THEN CAST(0.8 AS DECIMAL(2,1)) "
        "WHEN stat_hour BETWEEN 12 AND 17 OR stat_hour BETWEEN 22 AND 23 THEN CAST(0.6 AS DECIMAL(2,1)) "
        "ELSE CAST(0.4 AS DECIMAL(2,1)) END")
CUSTOMER_LABELS = ("'CUST' || LPAD(CAST(customer_id AS VARCHAR), 3, '0') AS customer_code, customer_name, "
                   "'UNKNOWN' AS customer_type")
CUSTOMER_BY_HOUR = f"""
SELECT customer_id, customer_name, {DAY_HOUR}, CAST(COUNT(DISTINCT device_id) AS INT) AS device_count,
  CAST(SUM(energy) AS DECIMAL(18,2)) AS energy, MAX(power) AS peak_power, {avg("power")}
FROM dwd WHERE customer_id > 0 GROUP BY ALL"""


def _customer_hour(cost: str) -> str:
    return f"""SELECT customer_id, {CUSTOMER_LABELS}, stat_date, stat_hour, device_count,
  CAST(energy AS {SUM_TYPE.upper()}) AS total_energy, peak_power, avg_power,
  CAST(energy * {cost} AS {COST_TYPE.upper()}) AS power_cost FROM ({CUSTOMER_BY_HOUR})"""


DEVICE_HOUR = f"""SELECT {DEVICE}, substation_id, substation_name, {DAY_HOUR}, {FULL}, {count_if(BAD, "abnormal_count")}
FROM dwd GROUP BY ALL"""
DEVICE_HOUR_TUMBLE = f"""SELECT {DEVICE}, substation_id, substation_name, window_start, window_end,
  CAST(window_start AS DATE) AS stat_date, CAST(hour(window_start) AS INT) AS stat_hour, {FULL},
  {count_if(BAD + " OR power_status <> 'NORMAL'", "abnormal_count")}
FROM (SELECT *, {window("1 hour")} FROM dwd) GROUP BY ALL"""
DEVICE_5MIN = f"""SELECT {DEVICE}, substation_name, stat_time, reading_count, avg_voltage, avg_current, avg_power,
  avg_temperature, avg_health_score AS health_score,
  CASE WHEN v > 0 OR t > 0 OR p > 0 THEN 'WARNING' WHEN avg_health_score < 70 THEN 'FAULT' ELSE 'NORMAL' END AS status
FROM (SELECT {DEVICE}, substation_name, {bucket("5 minutes")} AS stat_time, {FULL},
  {count_if("voltage_status <> 'NORMAL'", "v")}, {count_if("temperature_status = 'HIGH'", "t")},
  {count_if("power_status <> 'NORMAL'", "p")} FROM dwd GROUP BY ALL)"""
SUBSTATION_HOUR = f"""SELECT substation_id, substation_name, {DAY_HOUR},
  {distinct("true", "total_devices")}, {distinct(GOOD, "active_devices")}, {total("power", "total_power")},
  {avg("voltage")}, {avg("temperature")}, CAST(0 AS BIGINT) AS alarm_count, {avg("health_score", "health_score")}
FROM dwd GROUP BY ALL"""
SUBSTATION_TUMBLE = f"""SELECT substation_id, substation_name, {DAY_HOUR},
  {distinct("true", "total_devices")}, {distinct(GOOD, "active_devices")}, {distinct(BAD, "warning_devices")},
  0 AS fault_devices, {total("power", "total_power")}, {avg("voltage")}, {avg("current_val", "avg_current")},
  {avg("temperature")}, CAST(0 AS BIGINT) AS alarm_count, {avg("health_score", "health_score")}
FROM dwd GROUP BY ALL"""
DEVICE_30S = f"""SELECT {DEVICE}, substation_name, {window("30 seconds")}, COUNT(*) AS reading_count, {ELECTRIC},
  {avg("temperature")}, MAX(temperature) AS max_temperature, {avg("health_score")}, {count_if(BAD, "abnormal_count")}
FROM gen GROUP BY ALL"""
SUBSTATION_30S = f"""SELECT substation_name, {window("30 seconds")}, {distinct("true", "total_devices")},
  {distinct(GOOD, "active_devices")}, {distinct(BAD, "warning_devices")}, {total("power", "total_power")},
  {avg("voltage")}, {avg("temperature")}, {avg("health_score")} FROM gen GROUP BY ALL"""
DEVICE_20S = f"""SELECT device_id, device_code, substation_name, {window("20 seconds")}, COUNT(*) AS record_count,
  {avg("voltage")}, MAX(voltage) AS max_voltage, MIN(voltage) AS min_voltage, {avg("temperature")},
  MAX(temperature) AS max_temperature, {avg("health_score")}, {count_if("status = 'WARNING'", "abnormal_count")},
  'DWS-汇总数据层' AS layer_info FROM simple GROUP BY ALL"""
MONITOR = """voltage AS latest_voltage, current_val AS latest_current, power AS latest_power,
  energy AS latest_energy, power_factor, frequency, temperature, health_score"""
DEVICE_REALTIME = f"""SELECT {DEVICE}, substation_name, {MONITOR}, {GRADED_STATUS} AS status,
  reading_time AS last_update_time
FROM (SELECT d.*, l.* EXCLUDE (device_id), {H1} AS health_score, {VOLT3} AS voltage_status, {TEMP3} AS temperature_status
      FROM latest l JOIN device d ON l.device_id = d.device_id)"""
GENERATED_MONITOR = f"""SELECT {DEVICE}, substation_name, {MONITOR}, {FOUR_STATUS} AS status,
  reading_time AS last_update_time FROM gen SEMI JOIN latest USING (device_id, reading_time)"""
RAW_HOURS = f"""SELECT device_id, date_trunc('hour', reading_time) AS hour_time, COUNT(*) AS reading_count,
  {avg("voltage")}, {avg("current_val", "avg_current")}, {avg("power")}, {avg("temperature")}
FROM meter_reading GROUP BY ALL"""
LATE = "(SELECT newest FROM clock)"
HOUR_END = "CAST(stat_date AS TIMESTAMP) + to_hours(CAST(stat_hour + 1 AS INT))"
BATCH_STATES = f"""SELECT {DEVICE}, substation_id, substation_name, reading_time, voltage, current_val, power, energy,
  power_factor, frequency, temperature, {H5} AS health_score, CASE WHEN (voltage <> 0 AND (voltage > 240
    OR voltage < 200)) OR temperature > 80 THEN 'WARNING' ELSE 'NORMAL' END AS status
FROM latest JOIN device USING (device_id)"""


def closed(sql: str, end: str) -> str:
    """Only windows the watermark has passed when the stream is drained."""
    return f"SELECT * FROM ({sql}) WHERE {end} <= {LATE} - INTERVAL 5 SECOND"


def _compared(*measures: str) -> str:
    pairs = ", ".join(f"r.{m} AS raw_{m}, w.{m} AS dws_{m}" for m in measures)
    same = " AND ".join(f"r.{m} IS NOT DISTINCT FROM w.{m}" for m in measures)
    return (f"{pairs}, CASE WHEN w.device_id IS NULL THEN 'raw_only' WHEN r.device_id IS NULL THEN 'dws_only' "
            f"WHEN {same} THEN 'match' ELSE 'differs' END AS verdict")


BODIES = {
    # sources
    "ods_meter_reading": "SELECT * FROM meter_reading",
    "ods_device_info": "SELECT * FROM device_info",
    "ods_substation": "SELECT * FROM substation",
    "ods_customer": "SELECT * FROM grid_customer",
    "ods_customer_device": "SELECT * FROM customer_device",
    "ods_alarm_info": "SELECT * FROM alarm_info",
    "ods_device_info_ordered": "SELECT * FROM device_info ORDER BY id",
    "ods_latest_1000": "SELECT * FROM meter_reading ORDER BY id DESC LIMIT 1000",
    "limit_10": "SELECT device_id, voltage, current_val, power FROM meter_reading ORDER BY id LIMIT 10",
    # grades
    **{f"grade_g{n}": f"SELECT id, voltage, temperature, power_factor, frequency, {rule} AS health_score "
                      "FROM meter_reading" for n, rule in ((1, H1), (2, H2), (3, H3))},
    "grade_g4": f"SELECT device_id, voltage, temperature, {H4} AS health_score, {RAW_STATUS} AS status, "
                "'CDC-实时数据层' AS layer_info FROM meter_reading",
    "grade_g5": f"SELECT id, voltage, temperature, power_factor, {H5} AS health_score, "
                "CASE WHEN (voltage <> 0 AND (voltage > 240 OR voltage < 200)) OR temperature > 80 THEN 'WARNING' "
                "ELSE 'NORMAL' END AS status FROM meter_reading",
    # detail
    "dwd_device_meter_detail": "SELECT * FROM dwd",
    "dwd_no_customer": f"SELECT {DEVICE}, substation_name, reading_time, voltage, current_val, power, energy, "
                       f"power_factor, frequency, temperature, {H1} AS health_score, {VOLT3} AS voltage_status, "
                       f"{TEMP3} AS temperature_status, {_power(3500, 2500)} AS power_status "
                       "FROM meter_reading JOIN device USING (device_id)",
    "dwd_status_v4": "SELECT device_id, device_code, device_name, substation_name, voltage, current_val, power, "
                     f"temperature, {H1} AS health_score, {RAW_STATUS} AS status, 'DWD-明细数据层' AS layer_info "
                     "FROM meter_reading JOIN device USING (device_id)",
    "dwd_generated": "SELECT * FROM gen",
    "dwd_simple": f"SELECT device_id, {CODE} AS device_code, '设备' || CAST(device_id AS VARCHAR) AS device_name, "
                  f"'METER' AS device_type, {STATION2} AS substation_name, voltage, current_val, power, temperature, "
                  f"{H1} AS health_score, {VOLT3} AS voltage_status, {TEMP3} AS temperature_status, "
                  f"{RAW_STATUS} AS status, 'DWD-明细数据层' AS layer_info FROM meter_reading",
    "quick_monitor": f"SELECT device_id, {CODE} AS device_code, voltage, power, temperature, {H3} AS health_score, "
                     "CASE WHEN voltage > 240 OR temperature > 80 THEN 'WARNING' ELSE 'NORMAL' END AS status "
                     "FROM meter_reading",
    "monitor_recent_hour": f"SELECT {DEVICE}, substation_name, {MONITOR}, {RAW_STATUS} AS status, "
                           f"reading_time AS last_update_time FROM (SELECT *, {H1} AS health_score "
                           f"FROM meter_reading JOIN device USING (device_id)) "
                           f"WHERE reading_time > {LATE} - INTERVAL 1 HOUR",
    "ads_device_monitor_4level": f"SELECT {DEVICE}, substation_name, {MONITOR}, {FOUR_STATUS} AS status, "
                                 "reading_time AS last_update_time FROM gen",
    "ads_monitor_simple": "SELECT device_id, device_code, substation_name, voltage AS latest_voltage, "
                          "temperature AS latest_temperature, health_score, status, 'ADS-应用数据层' AS layer_info "
                          "FROM simple",
    "console_dwd": "SELECT 'DWD-明细层' AS layer_name, device_id, device_code, substation_name, "
                   "'健康度' AS metric_name, CAST(health_score AS VARCHAR) AS metric_value, "
                   f"CASE WHEN {BAD} THEN 'WARNING' ELSE 'NORMAL' END AS status FROM gen",
    "console_dwd_graded": "SELECT device_id, device_code, substation_name, voltage, temperature, health_score, "
                          f"{RAW_STATUS} AS status, 'DWD-明细数据层' AS layer_info FROM (SELECT *, {H1} AS health_score "
                          "FROM meter_reading JOIN device USING (device_id))",
    "console_dws": "SELECT 'DWS-汇总层' AS layer_name, device_id, device_code, substation_name, "
                   "'30秒平均电压' AS metric_name, CAST(avg_voltage AS VARCHAR) AS metric_value, "
                   f"CASE WHEN abnormal_count > 0 THEN 'WARNING' ELSE 'NORMAL' END AS status FROM ({DEVICE_30S})",
    # summaries
    "dws_device_hour": DEVICE_HOUR,
    "dws_device_hour_tumble": DEVICE_HOUR_TUMBLE,
    "dws_device_5min": DEVICE_5MIN,
    "dws_substation_hour": SUBSTATION_HOUR,
    "dws_substation_hour_tumble": SUBSTATION_TUMBLE,
    "dws_customer_hour": _customer_hour("CAST(0.6 AS DECIMAL(2,1))"),
    "dws_customer_hour_tou": _customer_hour(RATE),
    "customer_power_statistics": f"""
SELECT customer_id, {CUSTOMER_LABELS}, stat_date, CAST(energy AS {SUM_TYPE.upper()}) AS total_energy, peak_power,
  avg_power, CAST(cost AS {COST_TYPE.upper()}) AS power_cost
FROM (SELECT customer_id, customer_name, CAST(reading_time AS DATE) AS stat_date, SUM(energy) AS energy,
        MAX(power) AS peak_power, {avg("power")} FROM dwd WHERE customer_id > 0 GROUP BY ALL)
JOIN (SELECT customer_id, customer_name, stat_date, SUM(energy * {RATE}) AS cost FROM ({CUSTOMER_BY_HOUR}) GROUP BY ALL)
USING (customer_id, customer_name, stat_date)""",
    "dws_device_30s": DEVICE_30S,
    "dws_substation_30s": SUBSTATION_30S,
    "dws_device_20s": DEVICE_20S,
    "dws_device_30s_simple": f"SELECT device_id, device_code, substation_name, {avg('voltage')}, "
                             f"{avg('temperature')}, {avg('health_score')}, COUNT(*) AS record_count, "
                             f"'DWS-汇总数据层' AS layer_info, {window('30 seconds')} FROM simple GROUP BY ALL",
    "ads_device_hour_copy": f"SELECT {DEVICE}, substation_name, stat_date, stat_hour, reading_count, avg_voltage, "
                            "max_voltage, min_voltage, avg_current, max_current, avg_power, max_power, total_energy, "
                            f"avg_temperature, max_temperature, avg_health_score, abnormal_count FROM ({DEVICE_HOUR})",
    # serving
    "ads_device_realtime": DEVICE_REALTIME,
    "ads_substation_overview": f"""
SELECT substation_id, substation_name, total_devices, active_devices AS normal_devices,
  total_devices - active_devices AS warning_devices, 0 AS fault_devices, total_power, avg_voltage,
  CAST(0 AS DECIMAL(8,2)) AS avg_current, avg_temperature, 0 AS active_alarms
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY substation_id ORDER BY stat_date DESC, stat_hour DESC) AS rn
      FROM ({SUBSTATION_HOUR})) WHERE rn = 1""",
    "ads_device_states_batch": BATCH_STATES,
    "ads_substation_overview_batch": f"""
SELECT substation_id, substation_name, CAST(COUNT(*) AS INT) AS total_devices,
  {count_if("status = 'NORMAL'", "normal_devices", "INT")}, {count_if("status <> 'NORMAL'", "warning_devices", "INT")},
  CAST(coalesce(SUM(power), 0) AS {SUM_TYPE.upper()}) AS total_power,
  CAST(coalesce({avg_ratio("SUM(voltage)", "COUNT(NULLIF(voltage, 0))", "decimal(8,2)")}, 0) AS DECIMAL(8,2)) AS avg_voltage,
  CAST(coalesce({avg_ratio("SUM(temperature)", "COUNT(NULLIF(temperature, 0))", "decimal(5,2)")}, 0) AS DECIMAL(5,2)) AS avg_temperature
FROM ({BATCH_STATES})
GROUP BY substation_id, substation_name""",
    "alarm_statistics": """
SELECT alarm_date, alarm_hour, substation_id, substation_name, device_type, alarm_type, alarm_level,
  CAST(COUNT(*) AS INT) AS alarm_count, CAST(COUNT(sec) AS INT) AS resolved_count,
  CAST(CAST((2 * CAST(SUM(sec) AS HUGEINT) * 100 + 60 * COUNT(sec)) // NULLIF(120 * COUNT(sec), 0) AS DECIMAL(18,0))
    * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS avg_resolution_time
FROM (SELECT *, CAST(alarm_time AS DATE) AS alarm_date, CAST(hour(alarm_time) AS INT) AS alarm_hour,
        CASE WHEN status = 'RESOLVED' THEN date_diff('second', alarm_time, resolved_time) END AS sec
      FROM alarm_info JOIN device USING (device_id))
GROUP BY alarm_date, alarm_hour, substation_id, substation_name, device_type, alarm_type, alarm_level""",
    "substation_hour_with_alarms": f"""
SELECT h.* EXCLUDE (alarm_count, fault_devices), coalesce(a.alarm_count, 0) AS alarm_count,
  coalesce(a.fault_devices, 0) AS fault_devices
FROM ({SUBSTATION_TUMBLE}) h
LEFT JOIN (SELECT substation_id, CAST(alarm_time AS DATE) AS stat_date, CAST(hour(alarm_time) AS INT) AS stat_hour,
    COUNT(*) AS alarm_count,
    {distinct("status = 'ACTIVE' AND alarm_level IN ('ERROR', 'CRITICAL')", "fault_devices")}
  FROM alarm_info JOIN device USING (device_id) GROUP BY ALL) a
USING (substation_id, stat_date, stat_hour)""",
    # dashboards
    "dash_status_summary": f"""
SELECT status, device_count,
  CAST(CAST((2 * CAST(device_count * 1000 AS HUGEINT) + everything) // (2 * everything) AS DECIMAL(18,0))
    * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(5,1)) AS percentage
FROM (SELECT status, COUNT(*) AS device_count, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS everything
      FROM ({GENERATED_MONITOR}) GROUP BY status)
ORDER BY device_count DESC, status""",
    "dash_latest_devices": "SELECT device_id, device_code, substation_name, latest_voltage, latest_power, temperature, "
                           f"health_score, status, last_update_time FROM ({GENERATED_MONITOR}) "
                           "ORDER BY last_update_time DESC, device_id LIMIT 8",
    "dash_substation_recent": "SELECT substation_name, total_devices, active_devices, warning_devices, total_power, "
                              f"avg_voltage, avg_temperature, window_start FROM ({SUBSTATION_30S}) "
                              f"WHERE window_start >= {LATE} - INTERVAL 5 MINUTE "
                              "ORDER BY window_start DESC, substation_name LIMIT 6",
    "dash_window_stats": f"""
SELECT COUNT(*) AS total_windows,
  {avg_ratio("SUM(reading_count)", "COUNT(reading_count)", "decimal(12,2)")} AS avg_readings_per_window,
  {avg("avg_voltage", "overall_avg_voltage", "voltage")}, {avg("avg_power", "overall_avg_power", "power")},
  CAST(coalesce(SUM(abnormal_count), 0) AS BIGINT) AS total_abnormal
FROM ({DEVICE_30S}) WHERE window_start >= {LATE} - INTERVAL 10 MINUTE""",
    "monitor_counts": f"""
SELECT 'readings_last_hour' AS metric, COUNT(*) AS value FROM meter_reading
WHERE reading_time > {LATE} - INTERVAL 1 HOUR
UNION ALL SELECT 'readings_today', COUNT(*) FROM meter_reading WHERE CAST(reading_time AS DATE) = CAST({LATE} AS DATE)
UNION ALL SELECT 'active_alarms', COUNT(*) FROM alarm_info WHERE status = 'ACTIVE'
UNION ALL SELECT 'alarms_today', COUNT(*) FROM alarm_info WHERE CAST(alarm_time AS DATE) = CAST({LATE} AS DATE)
UNION ALL SELECT 'devices', COUNT(*) FROM device_info WHERE status <> 'DELETED'
UNION ALL SELECT 'monitor_records', COUNT(DISTINCT device_id) FROM meter_reading""",
    "window_summary_recent": "SELECT device_id, device_code, substation_name, window_start, window_end, "
                             f"reading_count, avg_voltage, max_voltage, avg_power, abnormal_count FROM ({DEVICE_30S}) "
                             "ORDER BY window_start DESC, device_id LIMIT 10",
    "device_5min_recent": "SELECT device_id, stat_time, reading_count, avg_voltage, avg_current, avg_power, "
                          f"avg_temperature, health_score, status FROM ({DEVICE_5MIN}) "
                          f"WHERE stat_time >= {LATE} - INTERVAL 3 HOUR "
                          "ORDER BY stat_time DESC, device_id LIMIT 10",
    "substation_hour_recent": "SELECT substation_id, substation_name, stat_date, stat_hour, total_devices, "
                              "active_devices, warning_devices, total_power, avg_voltage, avg_temperature, "
                              f"health_score FROM ({SUBSTATION_TUMBLE}) "
                              f"WHERE stat_date >= CAST({LATE} - INTERVAL 1 DAY AS DATE) "
                              "ORDER BY stat_date DESC, stat_hour DESC, substation_id LIMIT 5",
    "customer_hour_recent": "SELECT customer_id, customer_name, stat_date, stat_hour, device_count, total_energy, "
                            f"peak_power, avg_power, power_cost FROM ({_customer_hour(RATE)}) "
                            f"WHERE stat_date >= CAST({LATE} - INTERVAL 1 DAY AS DATE) "
                            "ORDER BY stat_date DESC, stat_hour DESC, customer_id LIMIT 5",
    "device_sample": "SELECT device_id, device_code, latest_voltage, temperature, health_score, status "
                     f"FROM ({DEVICE_REALTIME}) ORDER BY device_id LIMIT 5",
    "dws_quality_stats": "SELECT COUNT(*) AS total_records, COUNT(DISTINCT device_id) AS unique_devices, "
                         f"MIN(stat_date) AS min_date, MAX(stat_date) AS max_date FROM ({DEVICE_HOUR})",
    "dws_abnormal_stats": "SELECT COUNT(*) AS abnormal_voltage_count, "
                          f"{avg('avg_voltage', 'overall_avg_voltage', 'voltage')}, "
                          "MAX(max_voltage) AS max_voltage_recorded, MIN(min_voltage) AS min_voltage_recorded "
                          f"FROM ({DEVICE_HOUR}) WHERE avg_voltage < 200 OR avg_voltage > 250",
    # reads
    "raw_hourly_device": RAW_HOURS,
    "device_hour_listing": "SELECT device_id, stat_date, stat_hour, reading_count, avg_voltage, avg_current, "
                           f"avg_power, avg_temperature, avg_health_score FROM ({DEVICE_HOUR}) "
                           f"WHERE stat_date >= CAST({LATE} - INTERVAL 1 DAY AS DATE) "
                           "ORDER BY device_id, stat_date, stat_hour",
    "device_stats": f"SELECT device_id, COUNT(*) AS total_readings, {avg('voltage')}, "
                    "MAX(temperature) AS max_temp FROM meter_reading GROUP BY device_id",
    "device_latest_reading": "SELECT device_id, voltage, current_val, power, temperature, reading_time FROM latest",
    "readings_per_device": "SELECT device_id, COUNT(*) AS records FROM meter_reading GROUP BY device_id",
    "device_with_substation": "SELECT device_id, device_name, device_type, substation_name FROM device",
    "customer_device_list": "SELECT c.id AS customer_id, customer_name, d.id AS device_id, device_name, "
                            "relationship_type FROM grid_customer c JOIN customer_device cd ON c.id = cd.customer_id "
                            "JOIN device_info d ON cd.device_id = d.id",
    "point_lookup": "SELECT id, device_name FROM device_info WHERE id IN (SELECT device_id FROM alarm_info)",
    "table_counts": "SELECT 'substation' AS table_name, COUNT(*) AS record_count FROM substation UNION ALL "
                    "SELECT 'device_info', COUNT(*) FROM device_info UNION ALL "
                    "SELECT 'meter_reading', COUNT(*) FROM meter_reading",
    # changes and checks
    "cdc_apply_latest": "SELECT seq, account_id, balance, changed_at FROM (SELECT *, ROW_NUMBER() OVER "
                        "(PARTITION BY account_id ORDER BY seq DESC) AS rn FROM changelog) WHERE rn = 1 AND op <> 'd'",
    "voltage_correction": "SELECT id, device_id, CASE WHEN voltage < 220 "
                          "THEN CAST(voltage * CAST(1.02 AS DECIMAL(3,2)) AS DECIMAL(8,2)) ELSE voltage END AS voltage "
                          "FROM meter_reading",
    "alarm_resolve": "SELECT id, device_id, alarm_type, alarm_level, alarm_time, 'RESOLVED' AS status, "
                     f"CASE WHEN status = 'ACTIVE' THEN {LATE} ELSE resolved_time END AS resolved_time FROM alarm_info",
    "substation_maintenance_update": "SELECT id, name, location, voltage_level, capacity, CASE WHEN EXISTS (SELECT 1 "
                                     "FROM device_info d WHERE d.substation_id = s.id AND d.status = 'MAINTENANCE') "
                                     "THEN 'MAINTENANCE' ELSE status END AS status FROM substation s",
    "devices_not_deleted": "SELECT * FROM device_info WHERE status <> 'DELETED'",
    "contact_update": """
SELECT c.id, customer_code, customer_name, customer_type, address, created_at,
  CASE WHEN u.o_custkey IS NULL THEN phone ELSE '18' || LPAD(CAST(o_orderkey AS VARCHAR), 9, '0') END AS phone,
  CASE WHEN u.o_custkey IS NULL THEN email
       WHEN o_orderkey % 5 <> 0 THEN 'order' || CAST(o_orderkey AS VARCHAR) || '@example.org' END AS email,
  CASE WHEN u.o_custkey IS NULL THEN updated_at ELSE o_orderdate END AS updated_at
FROM grid_customer c LEFT JOIN (
  SELECT * FROM orders o WHERE o_orderkey = (SELECT MAX(l.o_orderkey) FROM orders l WHERE l.o_custkey = o.o_custkey)) u
ON c.id = u.o_custkey + 1""",
    "customers_deletable": "SELECT * FROM grid_customer c WHERE NOT EXISTS "
                           "(SELECT 1 FROM customer_device cd WHERE cd.customer_id = c.id)",
    "retention_readings": f"SELECT * FROM meter_reading WHERE NOT (reading_time < {LATE} - INTERVAL 7 DAY)",
    "retention_alarms": "SELECT * FROM alarm_info WHERE NOT coalesce(status = 'RESOLVED' AND "
                        f"resolved_time < {LATE} + INTERVAL 10 DAY - INTERVAL 30 DAY, false)",
    "duplicate_keys": "SELECT 'device_info' AS table_name, device_code AS code, COUNT(*) AS occurrences "
                      "FROM device_info GROUP BY device_code HAVING COUNT(*) > 1 UNION ALL "
                      "SELECT 'grid_customer', customer_code, COUNT(*) FROM grid_customer GROUP BY customer_code "
                      "HAVING COUNT(*) > 1",
    "orphan_readings": "SELECT id, device_id, reading_time FROM meter_reading m WHERE NOT EXISTS "
                       "(SELECT 1 FROM device_info d WHERE d.id = m.device_id)",
    "orphan_devices": "SELECT id, substation_id FROM device_info d WHERE NOT EXISTS "
                      "(SELECT 1 FROM substation s WHERE s.id = d.substation_id)",
    "orphan_relations": "SELECT id, 'customer' AS missing FROM customer_device r WHERE NOT EXISTS "
                        "(SELECT 1 FROM grid_customer c WHERE c.id = r.customer_id) UNION ALL "
                        "SELECT id, 'device' FROM customer_device r WHERE NOT EXISTS "
                        "(SELECT 1 FROM device_info d WHERE d.id = r.device_id)",
    "orphan_alarms": "SELECT id, device_id, alarm_time FROM alarm_info a WHERE NOT EXISTS "
                     "(SELECT 1 FROM device_info d WHERE d.id = a.device_id)",
    "reconcile_hour": f"""
SELECT coalesce(r.device_id, w.device_id) AS device_id, coalesce(r.stat_date, w.stat_date) AS stat_date,
  coalesce(r.stat_hour, w.stat_hour) AS stat_hour,
  {_compared("reading_count", "avg_voltage", "avg_current", "avg_power", "avg_temperature")}
FROM (SELECT *, CAST(hour_time AS DATE) AS stat_date, CAST(hour(hour_time) AS INT) AS stat_hour FROM ({RAW_HOURS})) r
FULL JOIN ({DEVICE_HOUR}) w
ON r.device_id = w.device_id AND r.stat_date = w.stat_date AND r.stat_hour = w.stat_hour""",
    "layer_flow": f"""
SELECT 'ods' AS layer, COUNT(*) AS row_count, {count_if(f"reading_time >= {LATE} - INTERVAL 1 DAY", "fresh_rows")},
  MAX(reading_time) AS last_time FROM meter_reading
UNION ALL
SELECT 'dwd', COUNT(*), {count_if(f"reading_time >= {LATE} - INTERVAL 1 DAY", "fresh_rows")}, MAX(reading_time) FROM dwd
UNION ALL
SELECT 'dws', COUNT(*), {count_if(f"hour_time >= {LATE} - INTERVAL 1 DAY", "fresh_rows")}, MAX(hour_time)
FROM (SELECT CAST(stat_date AS TIMESTAMP) + to_hours(stat_hour) AS hour_time FROM ({DEVICE_HOUR}))
UNION ALL
SELECT 'ads', COUNT(*), {count_if(f"last_update_time >= {LATE} - INTERVAL 1 DAY", "fresh_rows")},
  MAX(last_update_time) FROM ({DEVICE_REALTIME})""",
    "upsert_latest_by_key": "SELECT device_id, reading_time, CASE WHEN voltage < 220 "
                            "THEN CAST(voltage * CAST(1.02 AS DECIMAL(3,2)) AS DECIMAL(8,2)) ELSE voltage END AS voltage, "
                            "id FROM meter_reading",
    # streams
    "stream_tumble_device": closed(DEVICE_30S, "window_end"),
    "stream_substation_30s": closed(SUBSTATION_30S, "window_end"),
    "stream_device_5min": closed(DEVICE_5MIN, "stat_time + INTERVAL 5 MINUTE"),
    "stream_device_20s": closed(DEVICE_20S, "window_end"),
    "stream_customer_hour_tou": closed(_customer_hour(RATE), HOUR_END),
    "stream_substation_hour": closed(SUBSTATION_TUMBLE, HOUR_END),
    "stream_limit_10": "SELECT least(10, COUNT(*)) AS row_count, least(10, COUNT(*)) AS known_rows FROM meter_reading",
    "stream_device_hour": DEVICE_HOUR,
    "stream_device_hour_idle": DEVICE_HOUR,
    "stream_substation_hour_running": SUBSTATION_HOUR,
    "stream_customer_hour_running": _customer_hour("CAST(0.6 AS DECIMAL(2,1))"),
    "stream_latest_device": DEVICE_REALTIME,
    "stream_dwd_enrich": "SELECT * FROM dwd",
    "stream_dedup": "SELECT * FROM meter_reading",
    # stored tables and the chain of layers: what a batch build gives
    "reconcile_by_digest": f"""
SELECT device_id, stat_date, stat_hour, reading_count AS raw_reading_count, avg_voltage AS raw_avg_voltage,
  avg_power AS raw_avg_power, reading_count + 1 AS dws_reading_count, avg_voltage AS dws_avg_voltage,
  avg_power AS dws_avg_power, 'differs' AS verdict FROM ({DEVICE_HOUR})
WHERE (device_id * 31 + stat_hour) % 50 = 0""",
    "retention_by_file": f"SELECT * FROM meter_reading WHERE reading_time >= {LATE} - INTERVAL 7 DAY",
    "recent_by_file": f"SELECT * FROM meter_reading WHERE reading_time >= {LATE} - INTERVAL 1 HOUR",
    "stream_dwd_revised": "SELECT * FROM dwd",
    "chain_device_hour": DEVICE_HOUR,
    "chain_customer_hour": _customer_hour("CAST(0.6 AS DECIMAL(2,1))"),
    "chain_device_monitor": DEVICE_REALTIME,
}
BODIES |= {"publish_once": BODIES["upsert_latest_by_key"]}
BODIES |= {"stream_cdc_apply": BODIES["cdc_apply_latest"], "chain_substation_overview": BODIES["ads_substation_overview"]}


def _needs(sql: str) -> list[str]:
    """The helper tables a statement uses, each after the ones it uses itself."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    found: list[str] = []
    for name, body in SOURCES.items():
        if name in words:
            found += [n for n in [*_needs(body), name] if n not in found]
    return found


def statements() -> dict[str, str]:
    """Complete statement per query."""
    out = {}
    for key, body in BODIES.items():
        tables = ",\n".join(f"{name} AS ({SOURCES[name].strip()})" for name in _needs(body))
        out[key] = f"WITH {tables}\n{body.strip()}"
    return out
