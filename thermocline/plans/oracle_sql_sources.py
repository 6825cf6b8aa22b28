"""Oracle SQL for the feed, message and time-range queries (registered on import)."""

from __future__ import annotations

from thermocline.plans.oracle_sql import ALL_AGGS, ORACLE, READINGS, enrich_for, hourly_sql, r7, with_ctes

COMMON = [
    "timestamp",
    "location",
    "depth",
    "temperature",
    "salinity",
    "dissolved_oxygen",
    "ph",
    "turbidity",
    "chlorophyll",
    "current_speed",
    "current_direction",
]
NULL_D = "CAST(NULL AS DOUBLE)"


def common(overrides: dict[str, str] | None = None, extra: tuple[str, ...] = ()) -> str:
    """Select list of the common columns (doubles rounded), with per-column
    expression overrides."""
    o = overrides or {}
    cols = list(extra)
    for c in COMMON:
        e = o.get(c, f'"{c}"' if c == "timestamp" else c)
        if c in ("timestamp", "location") or e == NULL_D:
            cols.append(f"{e} AS {c}")
        else:
            cols.append(f"{r7(f'CAST({e} AS DOUBLE)')} AS {c}")
    return ", ".join(cols)


R = with_ctes(READINGS)
AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"

ORACLE["parse_json_readings"] = R + f" SELECT {common(extra=('event_id',))} FROM readings"
ORACLE["json_reading_defaults"] = R + (
    " SELECT "
    + common(
        {
            "depth": "CASE WHEN event_id % 17 = 0 THEN 0.0 ELSE depth END",
            "salinity": "CASE WHEN event_id % 19 = 0 THEN 0.0 ELSE salinity END",
        },
        extra=("event_id",),
    )
    + " FROM readings WHERE event_id % 97 <> 0"
)
ORACLE["json_reading_rejects"] = (
    "SELECT 'missing temperature' AS reason, count(*) AS n_messages FROM events WHERE event_id % 97 = 0"
)
ORACLE["last_24_hours"] = R + (
    f" SELECT {common(extra=('event_id',))} FROM readings"
    f' WHERE "timestamp" >= {AS_OF} - INTERVAL 24 HOUR AND "timestamp" <= {AS_OF}'
)

BAD_STATIONS = """,
bad AS (SELECT DISTINCT user_id % 50 AS st FROM readings WHERE user_id % 50 = 3 AND event_id % 7 = 0)
"""
STATION_SELECT = "SELECT " + common(
    {
        "timestamp": "date_trunc('minute', \"timestamp\")",
        "location": "CAST(41000 + user_id % 50 AS VARCHAR)",
        "depth": "0.0",
        "temperature": "CASE WHEN event_id % 13 = 0 THEN 0.0 ELSE temperature END",
        "dissolved_oxygen": NULL_D,
        "ph": NULL_D,
        "turbidity": NULL_D,
        "chlorophyll": NULL_D,
        "current_speed": "coalesce(current_speed, 0.0)",
        "current_direction": "coalesce(current_direction, 0.0)",
    }
) + " FROM readings WHERE user_id % 50 NOT IN (SELECT st FROM bad)"
ORACLE["ndbc_station_feed"] = R + BAD_STATIONS + STATION_SELECT
ORACLE["station_rejects"] = R + """,
bad AS (SELECT DISTINCT user_id % 50 AS st FROM readings WHERE user_id % 50 = 3 AND event_id % 7 = 0)
SELECT CAST(41000 + user_id % 50 AS VARCHAR) AS location,
       CASE WHEN user_id % 50 = 3 AND event_id % 7 = 0 THEN 'fewer than 15 fields'
            ELSE 'file has a short row' END AS reason,
       count(*) AS n_lines
FROM readings WHERE user_id % 50 IN (SELECT st FROM bad) GROUP BY 1, 2"""
ORACLE["landed_station_feed"] = ORACLE["ndbc_station_feed"]
ORACLE["landed_station_rejects"] = R + """,
bad AS (SELECT DISTINCT user_id % 50 AS st FROM readings WHERE user_id % 50 = 3 AND event_id % 7 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id % 50 ORDER BY event_id) + 1 AS line_no FROM readings)
SELECT CAST(41000 + user_id % 50 AS VARCHAR) AS location,
       CASE WHEN user_id % 50 = 3 AND event_id % 7 = 0 THEN 'fewer than 15 fields'
            ELSE 'file has a short row' END AS reason,
       count(*) AS n_lines, min(line_no) AS first_line
FROM numbered WHERE user_id % 50 IN (SELECT st FROM bad) GROUP BY 1, 2"""
ORACLE["ndbc_station_list"] = "SELECT DISTINCT CAST(41000 + user_id % 50 AS VARCHAR) AS station_id FROM events"

OBSERVATORY = R + " SELECT " + common(
    {
        "chlorophyll": "coalesce(chlorophyll, 0.0)",
        "current_speed": "coalesce(current_speed, 0.0)",
        "current_direction": "coalesce(current_direction, 0.0)",
    }
) + " FROM readings WHERE event_type <> 'error'"
ORACLE["ooi_feed"] = OBSERVATORY
ORACLE["landed_observatory_feed"] = OBSERVATORY
ORACLE["ooi_inventory"] = (
    "SELECT DISTINCT 'station_' || CAST(user_id % 5 AS VARCHAR) AS node, event_type AS instrument"
    " FROM events WHERE event_type <> 'error'"
)

FLOATS = R + " SELECT " + common(
    {
        "depth": "(depth / 10.0) * 10.0",
        **{c: NULL_D for c in ["dissolved_oxygen", "ph", "turbidity", "chlorophyll", "current_speed", "current_direction"]},
    }
) + " FROM readings"
ORACLE["argo_profiles"] = FLOATS
ORACLE["argo_float_list"] = R + " SELECT DISTINCT location AS float_id FROM readings"
ORACLE["cmems_catalogue"] = R + (
    " SELECT DISTINCT location || '_' || strftime(\"timestamp\", '%Y-%m-%d') AS dataset_id FROM readings"
)
PRODUCTS = R + " SELECT " + common() + " FROM readings"
ORACLE["cmems_products"] = PRODUCTS

ORACLE["source_validity"] = R + """,
station AS (SELECT * FROM readings WHERE user_id % 50 NOT IN
            (SELECT DISTINCT user_id % 50 FROM readings WHERE user_id % 50 = 3 AND event_id % 7 = 0))
SELECT 'station' AS source, true AS has_columns, count(temperature) > 0 AS has_temperature,
       count(*) AS n_rows, count(temperature) > 0 AS valid FROM station
UNION ALL
SELECT 'observatory', true, count(temperature) > 0, count(*), count(temperature) > 0 FROM readings
UNION ALL
SELECT 'product', true, count(temperature) > 0, count(*), count(temperature) > 0 FROM readings
UNION ALL
SELECT 'float', true, count(temperature) > 0, count(*), true FROM readings"""


def _body(sql: str) -> str:
    return sql[len(R):]


ORACLE["all_sources_union"] = (
    R
    + BAD_STATIONS
    + f"SELECT *, 'station' AS source FROM ({STATION_SELECT})"
    + f" UNION ALL SELECT *, 'observatory' AS source FROM ({_body(OBSERVATORY)})"
    + f" UNION ALL SELECT *, 'float' AS source FROM ({_body(FLOATS)})"
    + f" UNION ALL SELECT *, 'product' AS source FROM ({_body(PRODUCTS)})"
)


# --- streams (closed windows only) and ML features -------------------------------


CLOSED = "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE"
ORACLE["ocean_metrics_stream"] = hourly_sql(
    None, enrich=enrich_for(list(ALL_AGGS)), gradient_partition="w, location, depth_layer", where=CLOSED
)

ORACLE["ocean_metrics_stream_profile"] = hourly_sql(None, enrich=enrich_for(list(ALL_AGGS)), where=CLOSED)
ORACLE["ocean_metrics_stream_staged"] = ORACLE["ocean_metrics_stream_profile"]

# Two deliveries: the second holds the later half of the time span and held-back rows of the first half; rows
# of windows that the first delivery closed are late.
DELIVERIES = """
dealt AS (
  SELECT *, CASE WHEN epoch_us("timestamp") < (SELECT (min(epoch_us("timestamp")) + max(epoch_us("timestamp"))) // 2 FROM {source})
                      AND event_id % 10 <> 3 THEN 1 ELSE 2 END AS delivery,
         time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS closes
  FROM {source}
), closed AS (
  SELECT max("timestamp") - INTERVAL 15 MINUTE AS mark FROM dealt WHERE delivery = 1 AND {usable}
), marked AS (
  SELECT dealt.*, delivery = 2 AND closes <= (SELECT mark FROM closed) AS late FROM dealt
)"""


def _delivered(source: str, usable: str = "true") -> str:
    return DELIVERIES.format(source=source, usable=usable)


ALL_READINGS = READINGS.replace("readings AS (", "all_readings AS (", 1)
ORACLE["ocean_metrics_stream_restart"] = ORACLE["ocean_metrics_stream_profile"].replace(
    READINGS, f"{ALL_READINGS}, {_delivered('all_readings')},\nreadings AS (SELECT * FROM marked WHERE NOT late)", 1
)
ORACLE["stream_late_counts"] = R + "," + _delivered("readings") + """
SELECT CAST(delivery - 1 AS BIGINT) AS batch, max("timestamp") AS max_event_time, count(*) AS n_messages,
       count(*) FILTER (late) AS n_late, CAST(0 AS BIGINT) AS n_rejected, count(*) FILTER (late) AS late_rows,
       CAST(coalesce(sum(event_id) FILTER (late), 0) AS BIGINT) AS late_id_sum
FROM marked GROUP BY delivery"""
USABLE = "event_id % 89 <> 5 AND event_id % 83 <> 7"
ORACLE["stream_rejects"] = R + "," + _delivered("readings", USABLE) + f""",
emitted AS (
  SELECT CAST(count(*) AS BIGINT) AS emitted_rows FROM marked
  WHERE {USABLE} AND NOT late AND closes <= (SELECT max("timestamp") FROM marked WHERE {USABLE}) - INTERVAL 15 MINUTE
)
SELECT CAST(delivery - 1 AS BIGINT) AS batch,
       CASE WHEN event_id % 89 = 5 THEN 'not a JSON object' ELSE 'missing or bad timestamp' END AS reason,
       count(*) AS n_messages, CAST(sum(event_id) AS BIGINT) AS id_sum,
       any_value(emitted_rows) AS emitted_rows
FROM marked, emitted WHERE NOT ({USABLE}) GROUP BY 1, 2"""

ORACLE["metrics_table_refresh"] = ORACLE["ocean_metrics"].replace(READINGS, f"{READINGS}, {_delivered('readings')}", 1).replace(
    "\nSELECT ",
    "\nSELECT CAST(window_start AS DATE) IN (SELECT DISTINCT CAST(\"timestamp\" AS DATE) FROM marked"
    " WHERE event_id % 10 = 3 AND epoch_us(\"timestamp\") < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events)) AS rewritten, ",
)

AIR = """
WITH air AS (
  SELECT ts AS "timestamp", 'sensor_' || CAST(user_id % 5 + 1 AS VARCHAR) AS location,
         350.0 + CAST(event_id % 151 AS DOUBLE) AS co2_level,
         15.0 + CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 AS DOUBLE) AS temperature,
         30.0 + CAST(event_id % 41 AS DOUBLE) AS humidity,
         value % 50.0 AS particulate_matter
  FROM events
),
m AS (
  SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start,
         time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS window_end,
         location, avg(co2_level) AS avg_co2, avg(temperature) AS avg_temp,
         avg(humidity) AS avg_humidity, max(particulate_matter) AS max_pm25
  FROM air GROUP BY 1, 2, 3
)"""
ORACLE["air_quality_stream"] = AIR + (
    f" SELECT window_start, window_end, location, {r7('avg_co2')} AS avg_co2, {r7('avg_temp')} AS avg_temp,"
    f" {r7('avg_humidity')} AS avg_humidity, {r7('max_pm25')} AS max_pm25 FROM m {CLOSED}"
)
ORACLE["air_features"] = AIR + (
    f" SELECT window_start, location, {r7('avg_co2')} AS feature_0, {r7('avg_temp')} AS feature_1,"
    f" {r7('avg_humidity')} AS feature_2, {r7('max_pm25')} AS feature_3,"
    f" {r7('0.01 * avg_co2 + 0.5 * avg_temp + 0.1 * avg_humidity + 0.2 * max_pm25')} AS impact_score FROM m"
)


def _is_test(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 100 < 20"


CHECKED = "true AS has_prediction, true AS same_prediction, true AS explains_held_out"
START = "strftime(window_start, '%Y-%m-%d %H:%M:%S')"
ORACLE["impact_model"] = AIR + (
    f" SELECT window_start, location, {r7('0.01 * avg_co2 + 0.5 * avg_temp + 0.1 * avg_humidity + 0.2 * max_pm25')} AS impact_score,"
    f" {_is_test(START + " || '|' || location")} AS is_test, {CHECKED} FROM m"
)
MODEL_COLUMNS = ["temp_avg", "salinity_avg", "oxygen_avg", "ph_avg", "oxygen_saturation_avg"]
ORACLE["ocean_model"] = (
    f"SELECT window_start, location, depth_layer, oxygen_saturation_avg,"
    f" {_is_test(START + " || '|' || location || '|' || depth_layer")} AS is_test, {CHECKED} FROM ({hourly_sql(MODEL_COLUMNS)})"
)
