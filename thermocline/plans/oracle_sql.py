"""DuckDB SQL for each registered query, written independently of the Spark
operators (plain SQL window functions and aggregates over the given tables).

Conventions: doubles rounded to 7 places as floor(x * 1e7 + 0.5) / 1e7, the same
IEEE operations the Spark side uses, so exact ties round alike; integer sums cast
to BIGINT; windows as ``time_bucket`` start/end.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def r7(expr: str) -> str:
    """Round to 7 decimals with the same IEEE steps as the Spark side."""
    return f"(floor(({expr}) * 1e7 + 0.5) / 1e7)"


READINGS = """
readings AS (
  SELECT event_id, user_id, event_type,
         ts AS "timestamp",
         'station_' || CAST(user_id % 5 AS VARCHAR) AS location,
         CAST(k * k AS DOUBLE) / 5.0 AS depth,
         24.0 - CAST(k AS DOUBLE) * 0.22 + CAST(event_id % 41 - 20 AS DOUBLE) * 0.5 AS temperature,
         34.5 + CAST(event_id % 23 - 11 AS DOUBLE) * 0.7 AS salinity,
         7.0 - CAST(k AS DOUBLE) * 0.05 + CAST(event_id % 29 - 14 AS DOUBLE) * 0.4 AS dissolved_oxygen,
         7.75 + CAST(event_id % 19 - 9 AS DOUBLE) * 0.1 AS ph,
         value AS turbidity,
         CASE WHEN event_id % 7 = 0 THEN NULL
              ELSE (value % 40.0) / (1.0 + CAST(k AS DOUBLE) / 10.0) END AS chlorophyll,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 37 AS DOUBLE) * 0.1 END AS current_speed,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 53) % 360 AS DOUBLE) END AS current_direction
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

DERIVED = """
derived AS (
  SELECT *,
         CASE WHEN depth <= 10 THEN 'surface' WHEN depth <= 100 THEN 'mixed_layer'
              WHEN depth <= 1000 THEN 'mesopelagic' ELSE 'deep_ocean' END AS depth_layer,
         1000.0 + 0.8 * salinity - 0.2 * temperature AS density,
         CASE WHEN 14.6 - 0.4 * temperature = 0 THEN NULL
              ELSE dissolved_oxygen / (14.6 - 0.4 * temperature) END AS oxygen_saturation
  FROM readings
)"""


def _layered(measure: str, bounds: dict[str, tuple[float, float]]) -> str:
    lo = " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in bounds.items())
    hi = " ".join(f"WHEN '{k}' THEN {v[1]}" for k, v in bounds.items())
    return (
        f"CASE WHEN {measure} BETWEEN (CASE depth_layer {lo} END) AND (CASE depth_layer {hi} END) "
        f"THEN 'pass' ELSE 'fail' END"
    )


def _fixed(measure: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {measure} BETWEEN {lo} AND {hi} THEN 'pass' ELSE 'fail' END"


# Written out again here on purpose: the oracle must not read the library's tables.
TEMP = {"surface": (-2.0, 35.0), "mixed_layer": (-2.0, 30.0), "mesopelagic": (-2.0, 25.0), "deep_ocean": (-2.0, 20.0)}
OXY = {"surface": (4.0, 12.0), "mixed_layer": (2.0, 10.0), "mesopelagic": (0.5, 8.0), "deep_ocean": (0.1, 6.0)}
CHL = {"surface": (0.0, 50.0), "mixed_layer": (0.0, 20.0), "mesopelagic": (0.0, 5.0), "deep_ocean": (0.0, 1.0)}

FLAGGED = f"""
flagged AS (
  SELECT *,
         {_layered('temperature', TEMP)} AS temp_qc_flag,
         {_fixed('salinity', 28.0, 41.0)} AS salinity_qc_flag,
         {_layered('dissolved_oxygen', OXY)} AS oxygen_qc_flag,
         {_fixed('ph', 7.0, 8.5)} AS ph_qc_flag,
         {_layered('chlorophyll', CHL)} AS chlorophyll_qc_flag,
         {_fixed('turbidity', 0.0, 50.0)} AS turbidity_qc_flag,
         {_fixed('current_speed', 0.0, 3.0)} AS current_speed_qc_flag
  FROM derived
)"""


def gradient_cte(bucket: str = "1 hour", partition: str = "w, location", name: str = "graded") -> str:
    """Rows with next depth/values along each profile (``partition``) and the
    three gradient flags, as plain SQL window functions."""
    over = f"OVER (PARTITION BY {partition} ORDER BY depth NULLS FIRST, \"timestamp\" NULLS FIRST, event_id)"
    return f"""
{name} AS (
  SELECT *,
         CASE WHEN abs(next_temp - temperature) / NULLIF(next_depth - depth, 0) > 0.5
              THEN 'fail' ELSE 'pass' END AS temp_gradient_qc,
         CASE WHEN abs(next_salinity - salinity) / NULLIF(next_depth - depth, 0) > 0.2
              THEN 'fail' ELSE 'pass' END AS salinity_gradient_qc,
         CASE WHEN abs(next_oxygen - dissolved_oxygen) / NULLIF(next_depth - depth, 0) > 0.5
              THEN 'fail' ELSE 'pass' END AS oxygen_gradient_qc
  FROM (
    SELECT *,
           lead(depth) {over} AS next_depth,
           lead(temperature) {over} AS next_temp,
           lead(salinity) {over} AS next_salinity,
           lead(dissolved_oxygen) {over} AS next_oxygen
    FROM (SELECT *, time_bucket(INTERVAL '{bucket}', "timestamp") AS w FROM flagged)
  )
)"""


def with_ctes(*ctes: str) -> str:
    """WITH clause of the given CTE bodies."""
    return "WITH " + ",".join(ctes)


BASE = with_ctes(READINGS, DERIVED, FLAGGED)


def fails(flag: str) -> str:
    """Count of 'fail' values of a flag column, as BIGINT."""
    return f"CAST(sum(CASE WHEN {flag} = 'fail' THEN 1 ELSE 0 END) AS BIGINT)"


RAW_AGGS = {
    "temp_avg": "avg(temperature)",
    "temp_std": "stddev_samp(temperature)",
    "temp_min": "min(temperature)",
    "temp_max": "max(temperature)",
    "salinity_avg": "avg(salinity)",
    "salinity_std": "stddev_samp(salinity)",
    "density_avg": "avg(density)",
    "oxygen_avg": "avg(dissolved_oxygen)",
    "oxygen_saturation_avg": "avg(oxygen_saturation)",
    "oxygen_min": "min(dissolved_oxygen)",
    "ph_avg": "avg(ph)",
    "ph_max_deviation": "max(abs(ph - grp_ph_avg))",
    "turbidity_avg": "avg(turbidity)",
    "turbidity_max": "max(turbidity)",
    "chlorophyll_avg": "avg(chlorophyll)",
    "chlorophyll_max": "max(chlorophyll)",
    "current_speed_avg": "avg(current_speed)",
    "current_speed_max": "max(current_speed)",
    "current_direction_sin_avg": "avg(sin(radians(current_direction)))",
    "current_direction_cos_avg": "avg(cos(radians(current_direction)))",
    "measurement_count": "count(*)",
    "min_depth": "min(depth)",
    "max_depth": "max(depth)",
    "temp_qc_failures": fails("temp_qc_flag"),
    "salinity_qc_failures": fails("salinity_qc_flag"),
    "oxygen_qc_failures": fails("oxygen_qc_flag"),
    "ph_qc_failures": fails("ph_qc_flag"),
    "gradient_qc_failures": fails("temp_gradient_qc"),
}

INTEGER_AGGS = {"measurement_count", "temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures",
                "ph_qc_failures", "gradient_qc_failures"}
ALL_AGGS = {k: (v if k in INTEGER_AGGS else r7(v)) for k, v in RAW_AGGS.items()}

# Post-aggregation expressions over the unrounded aggregate columns (prefixed u_).
ENRICH = {
    "current_direction_avg": (
        ["current_direction_sin_avg", "current_direction_cos_avg"],
        r7("degrees(atan2(u_current_direction_sin_avg, u_current_direction_cos_avg))"),
    ),
    "current_direction_compass": (
        ["current_direction_sin_avg", "current_direction_cos_avg"],
        r7(
            "((degrees(atan2(u_current_direction_sin_avg, u_current_direction_cos_avg)) % 360.0) + 360.0) % 360.0"
        ),
    ),
    "temp_gradient": (
        ["temp_max", "temp_min", "max_depth", "min_depth"],
        r7("(u_temp_max - u_temp_min) / NULLIF(u_max_depth - u_min_depth, 0)"),
    ),
    "data_quality": (
        ["measurement_count"],
        "CASE WHEN u_measurement_count >= 10 THEN 'high' WHEN u_measurement_count >= 5 THEN 'medium' ELSE 'low' END",
    ),
    "qc_score": (
        ["temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures", "ph_qc_failures", "gradient_qc_failures"],
        "CAST(100 - 5 * (u_temp_qc_failures + u_salinity_qc_failures + u_oxygen_qc_failures"
        " + u_ph_qc_failures + u_gradient_qc_failures) AS BIGINT)",
    ),
}


def hourly_sql(
    metrics: list[str] | None,
    bucket: str = "1 hour",
    enrich: list[str] = (),
    gradient_partition: str = "w, location",
    where: str = "",
) -> str:
    """Per (bucket, location, layer) statistics with optional E1-E5 columns."""
    metrics = list(metrics or ALL_AGGS)
    ctes = [READINGS, DERIVED, FLAGGED, gradient_cte(bucket, gradient_partition)]
    ctes.append(
        """
pre AS (
  SELECT *, avg(ph) OVER (PARTITION BY w, location, depth_layer) AS grp_ph_avg FROM graded
)"""
    )
    unrounded = {m: RAW_AGGS[m] for m in metrics}
    agg_cols = ",\n         ".join(
        [f"{ALL_AGGS[m]} AS {m}" for m in metrics] + [f"{unrounded[m]} AS u_{m}" for m in metrics]
    )
    ctes.append(
        f"""
agg AS (
  SELECT w AS window_start, w + INTERVAL '{bucket}' AS window_end, location, depth_layer,
         {agg_cols}
  FROM pre
  GROUP BY w, location, depth_layer
)"""
    )
    extra = []
    for e in enrich:
        if e == "quality_category":
            s = ENRICH["qc_score"][1]
            extra.append(
                f"CASE WHEN {s} >= 95 THEN 'excellent' WHEN {s} >= 85 THEN 'good' "
                f"WHEN {s} >= 75 THEN 'fair' ELSE 'poor' END AS quality_category"
            )
        else:
            extra.append(f"{ENRICH[e][1]} AS {e}")
    cols = ", ".join(["window_start", "window_end", "location", "depth_layer", *metrics, *extra])
    return with_ctes(*ctes) + f"\nSELECT {cols} FROM agg {where}"


def enrich_for(metrics: list[str]) -> list[str]:
    """E1-E5 outputs computable from ``metrics``, in output order."""
    have = set(metrics)
    out = [e for e, (need, _) in ENRICH.items() if set(need) <= have]
    if "qc_score" in out:
        out.append("quality_category")
    return out


def _register_core() -> None:
    o = ORACLE
    o["depth_layers"] = with_ctes(READINGS, DERIVED) + " SELECT event_id, location, depth, depth_layer FROM derived"
    o["derived_quantities"] = with_ctes(READINGS, DERIVED) + (
        f" SELECT event_id, {r7('density')} AS density, {r7('oxygen_saturation')} AS oxygen_saturation FROM derived"
    )
    o["qc_bounds_layered"] = BASE + (
        " SELECT event_id, depth_layer, temp_qc_flag, oxygen_qc_flag, chlorophyll_qc_flag FROM flagged"
    )
    o["qc_bounds_fixed"] = BASE + (
        " SELECT event_id, salinity_qc_flag, ph_qc_flag, turbidity_qc_flag, current_speed_qc_flag FROM flagged"
    )
    over = 'OVER (PARTITION BY location ORDER BY depth NULLS FIRST, "timestamp" NULLS FIRST, event_id)'
    o["profile_positions"] = with_ctes(READINGS) + (
        f" SELECT event_id, location, depth, CAST(row_number() {over} AS INTEGER) AS profile_position,"
        f" lead(depth) {over} AS next_depth, lead(temperature) {over} AS next_temp FROM readings"
    )
    o["gradient_qc"] = with_ctes(READINGS, DERIVED, FLAGGED, gradient_cte()) + (
        " SELECT event_id, location, next_depth, next_temp, temp_gradient_qc, salinity_gradient_qc,"
        " oxygen_gradient_qc FROM graded"
    )
    groups = {
        "hourly_temperature": ["temp_avg", "temp_std", "temp_min", "temp_max", "measurement_count"],
        "hourly_salinity_density": ["salinity_avg", "salinity_std", "density_avg"],
        "hourly_oxygen": ["oxygen_avg", "oxygen_saturation_avg", "oxygen_min"],
        "hourly_ph_deviation": ["ph_avg", "ph_max_deviation"],
        "hourly_turbidity_chlorophyll": ["turbidity_avg", "turbidity_max", "chlorophyll_avg", "chlorophyll_max"],
        "hourly_current_circular": [
            "current_speed_avg",
            "current_speed_max",
            "current_direction_sin_avg",
            "current_direction_cos_avg",
        ],
        "temp_gradient_span": ["temp_min", "temp_max", "min_depth", "max_depth"],
    }
    for name, ms in groups.items():
        enrich = [e for e in enrich_for(ms) if e != "data_quality"]
        o[name] = hourly_sql(ms, enrich=enrich)
    qc = ["temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures", "ph_qc_failures", "gradient_qc_failures"]
    o["qc_failure_counts"] = hourly_sql(qc)
    o["data_quality_classes"] = hourly_sql(["measurement_count"], bucket="6 hours", enrich=["data_quality"])
    full = hourly_sql(qc, bucket="6 hours", enrich=["qc_score", "quality_category"])
    o["qc_score_categories"] = (
        f"SELECT window_start, window_end, location, depth_layer, qc_score, quality_category FROM ({full})"
    )
    o["ocean_metrics"] = hourly_sql(None, enrich=enrich_for(list(ALL_AGGS)))
    o["metrics_table"] = o["ocean_metrics"]
    o["ocean_metrics_location_profiles"] = hourly_sql(
        None, enrich=enrich_for(list(ALL_AGGS)), gradient_partition="location"
    )
    o["ph_global_deviation"] = with_ctes(READINGS, DERIVED) + f"""
SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start,
       time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS window_end,
       location, depth_layer,
       {r7('(SELECT avg(ph) FROM derived)')} AS ph_global_mean,
       {r7('max(abs(ph - (SELECT avg(ph) FROM derived)))')} AS ph_max_global_deviation
FROM derived GROUP BY 1, 2, 3, 4"""
    o["air_quality_metrics"] = f"""
WITH air AS (
  SELECT ts AS "timestamp", 'sensor_' || CAST(user_id % 5 + 1 AS VARCHAR) AS location,
         350.0 + CAST(event_id % 151 AS DOUBLE) AS co2_level,
         15.0 + CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 16 AS DOUBLE) AS temperature,
         30.0 + CAST(event_id % 41 AS DOUBLE) AS humidity,
         value % 50.0 AS particulate_matter
  FROM events
)
SELECT time_bucket(INTERVAL '1 hour', "timestamp") AS window_start,
       time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour' AS window_end,
       location,
       {r7('avg(co2_level)')} AS avg_co2, {r7('avg(temperature)')} AS avg_temp,
       {r7('avg(humidity)')} AS avg_humidity, {r7('max(particulate_matter)')} AS max_pm25
FROM air GROUP BY 1, 2, 3"""


_register_core()


def register_all() -> None:
    """Import the modules that add oracle entries for feeds and streams."""
    from thermocline.plans import oracle_sql_sources  # noqa: F401
