"""Windowed statistics per (window, location, depth layer), shared by
batch and Structured Streaming, plus W5 (deviation from the global pH mean).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.functions.ocean import is_fail

GROUP_KEYS = ["location", "depth_layer"]


def _fail_count(flag: str) -> Column:
    return F.sum(is_fail(flag)).cast("bigint")


def ocean_aggregations() -> dict[str, Column]:
    """Every per-group statistic, by output name."""
    return {
        # temperature
        "temp_avg": F.avg("temperature"),
        "temp_std": F.stddev_samp("temperature"),
        "temp_min": F.min("temperature"),
        "temp_max": F.max("temperature"),
        # salinity and density
        "salinity_avg": F.avg("salinity"),
        "salinity_std": F.stddev_samp("salinity"),
        "density_avg": F.avg("density"),
        # oxygen
        "oxygen_avg": F.avg("dissolved_oxygen"),
        "oxygen_saturation_avg": F.avg("oxygen_saturation"),
        "oxygen_min": F.min("dissolved_oxygen"),
        # pH; max |ph - group mean| equals the larger distance of max or min from
        # the mean, so one pass suffices and it works on streams.
        "ph_avg": F.avg("ph"),
        "ph_max_deviation": F.greatest(F.max("ph") - F.avg("ph"), F.avg("ph") - F.min("ph")),
        # turbidity, chlorophyll
        "turbidity_avg": F.avg("turbidity"),
        "turbidity_max": F.max("turbidity"),
        "chlorophyll_avg": F.avg("chlorophyll"),
        "chlorophyll_max": F.max("chlorophyll"),
        # currents; direction as a circular mean of unit vectors
        "current_speed_avg": F.avg("current_speed"),
        "current_speed_max": F.max("current_speed"),
        "current_direction_sin_avg": F.avg(F.sin(F.radians("current_direction"))),
        "current_direction_cos_avg": F.avg(F.cos(F.radians("current_direction"))),
        # metadata
        "measurement_count": F.count(F.lit(1)),
        "min_depth": F.min("depth"),
        "max_depth": F.max("depth"),
        # QC failures
        "temp_qc_failures": _fail_count("temp_qc_flag"),
        "salinity_qc_failures": _fail_count("salinity_qc_flag"),
        "oxygen_qc_failures": _fail_count("oxygen_qc_flag"),
        "ph_qc_failures": _fail_count("ph_qc_flag"),
        "gradient_qc_failures": _fail_count("temp_gradient_qc"),
    }


# Output names in order (kept static: Columns need an active session).
ALL_METRICS = [
    "temp_avg", "temp_std", "temp_min", "temp_max",
    "salinity_avg", "salinity_std", "density_avg",
    "oxygen_avg", "oxygen_saturation_avg", "oxygen_min",
    "ph_avg", "ph_max_deviation",
    "turbidity_avg", "turbidity_max", "chlorophyll_avg", "chlorophyll_max",
    "current_speed_avg", "current_speed_max", "current_direction_sin_avg", "current_direction_cos_avg",
    "measurement_count", "min_depth", "max_depth",
    "temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures", "ph_qc_failures", "gradient_qc_failures",
]


def window_bounds(window_col: str = "window") -> list[Column]:
    """Window struct -> scalar window_start / window_end (wall-clock, no zone)."""
    return [
        F.col(f"{window_col}.start").cast("timestamp_ntz").alias("window_start"),
        F.col(f"{window_col}.end").cast("timestamp_ntz").alias("window_end"),
    ]


def ocean_metrics(
    df: DataFrame,
    duration: str = TH.WINDOW_DURATION,
    metrics: Sequence[str] | None = None,
    time_col: str = "timestamp",
    window_start_col: str | None = None,
) -> DataFrame:
    """Group by (tumbling window, location, depth_layer) and compute ``metrics``
    (default: all of A1-A28). Output: window_start, window_end, location,
    depth_layer, metrics...

    ``gradient_qc_failures`` sums the row-level ``temp_gradient_qc`` flag (batch; streams take
    ``operators.profile_summary``).

    ``window_start_col`` (batch only): group by an existing window-start column
    instead of ``window(time_col)``. When the frame is already hash-partitioned
    on (that column, location) — as after the profile window — the aggregate
    reuses that partitioning and needs no exchange of its own.
    """
    metrics = list(metrics or ALL_METRICS)
    all_aggs = ocean_aggregations()
    aggs = [all_aggs[m].alias(m) for m in metrics]
    if window_start_col:
        grouped = df.filter(F.col(window_start_col).isNotNull()).groupBy(window_start_col, *GROUP_KEYS).agg(*aggs)
        start = F.col(window_start_col)
        cols = [
            start.cast("timestamp_ntz").alias("window_start"),
            (start + F.expr(f"INTERVAL {duration}")).cast("timestamp_ntz").alias("window_end"),
            *GROUP_KEYS,
        ]
    else:
        grouped = df.groupBy(F.window(time_col, duration).alias("window"), *GROUP_KEYS).agg(*aggs)
        cols = [*window_bounds(), *GROUP_KEYS]
    return grouped.select(*cols, *metrics)


def ph_global_deviation(df: DataFrame, duration: str = TH.WINDOW_DURATION) -> DataFrame:
    """Per group, max |ph - mean of ph over the whole frame|.

    The global mean is a scalar subquery (one-row aggregate that Spark evaluates
    once and inlines); no cross join, no driver round trip in user code.
    """
    g = df.agg(F.avg("ph")).scalar()
    grouped = df.groupBy(F.window("timestamp", duration).alias("window"), *GROUP_KEYS).agg(
        F.max("ph").alias("_mx"), F.min("ph").alias("_mn")
    )
    return grouped.select(
        *window_bounds(),
        *GROUP_KEYS,
        g.alias("ph_global_mean"),
        F.greatest(F.col("_mx") - g, g - F.col("_mn")).alias("ph_max_global_deviation"),
    )


def air_quality_metrics(df: DataFrame, duration: str = TH.WINDOW_DURATION, time_col: str = "timestamp") -> DataFrame:
    """A31-A34 per (window, location): avg_co2, avg_temp, avg_humidity, max_pm25."""
    grouped = df.groupBy(F.window(time_col, duration).alias("window"), "location").agg(
        F.avg("co2_level").alias("avg_co2"),
        F.avg("temperature").alias("avg_temp"),
        F.avg("humidity").alias("avg_humidity"),
        F.max("particulate_matter").alias("max_pm25"),
    )
    return grouped.select(*window_bounds(), "location", "avg_co2", "avg_temp", "avg_humidity", "max_pm25")
