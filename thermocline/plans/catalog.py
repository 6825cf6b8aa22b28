"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables (through the fixtures) and runs the library's
operators over all rows. Floating results are rounded to 7 decimals so that the
DuckDB oracle, which sums in a different order, compares equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline import fixtures as FX
from thermocline.operators.derive import add_derived
from thermocline.operators.metrics import air_quality_metrics, ph_global_deviation
from thermocline.operators.qc import add_bound_flags, add_profile_neighbours
from thermocline.plans.ocean_metrics import flag_readings, ocean_metrics_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DECIMALS = 7


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def round_half_up(c, decimals: int = DECIMALS):
    """floor(x * 10^d + 0.5) / 10^d in double arithmetic: the oracle SQL does the
    same IEEE operations, so values that land exactly on a tie round alike."""
    scale = F.lit(float(10**decimals))
    return F.floor(c * scale + F.lit(0.5)).cast("double") / scale


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every DOUBLE column (comparison form only; the operators never round)."""
    return df.select(
        *[
            round_half_up(F.col(f.name), decimals).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


WINDOW_KEYS = ["window_start", "window_end", "location", "depth_layer"]


def _hourly(spark: SparkSession, sf_dir: str, metrics: list[str], duration: str = "1 hour") -> DataFrame:
    out = ocean_metrics_batch(FX.readings(spark, sf_dir), duration, metrics=metrics)
    return rounded(out)


# --- P, Q, W: row level ---------------------------------------------------------


@query("depth_layers")
def depth_layers(spark, sf_dir):
    df = add_derived(FX.readings(spark, sf_dir))
    return df.select("event_id", "location", "depth", "depth_layer")


@query("derived_quantities")
def derived_quantities(spark, sf_dir):
    df = add_derived(FX.readings(spark, sf_dir))
    return rounded(df.select("event_id", "density", "oxygen_saturation"))


@query("qc_bounds_layered")
def qc_bounds_layered(spark, sf_dir):
    df = add_bound_flags(add_derived(FX.readings(spark, sf_dir)), ["temperature", "dissolved_oxygen", "chlorophyll"])
    return df.select("event_id", "depth_layer", "temp_qc_flag", "oxygen_qc_flag", "chlorophyll_qc_flag")


@query("qc_bounds_fixed")
def qc_bounds_fixed(spark, sf_dir):
    df = add_bound_flags(add_derived(FX.readings(spark, sf_dir)), ["salinity", "ph", "turbidity", "current_speed"])
    return df.select("event_id", "salinity_qc_flag", "ph_qc_flag", "turbidity_qc_flag", "current_speed_qc_flag")


@query("profile_positions")
def profile_positions(spark, sf_dir):
    """W1-W3 in the original's shape: one profile per location over all time
    (five huge groups: the hot-key case the skew-safe operator is built for)."""
    df = add_profile_neighbours(
        FX.readings(spark, sf_dir), keys=["location"], position_col="profile_position"
    )
    position = F.col("profile_position").cast("int").alias("profile_position")
    return df.select("event_id", "location", "depth", position, "next_depth", "next_temp")


@query("gradient_qc")
def gradient_qc(spark, sf_dir):
    """Q5, Q9, Q10 over hourly profiles per location."""
    df = flag_readings(
        FX.readings(spark, sf_dir),
        gradient_scope="profile",
        gradients=("temperature", "salinity", "dissolved_oxygen"),
        keep_neighbours=True,
    )
    return df.select(
        "event_id",
        "location",
        "next_depth",
        "next_temp",
        "temp_gradient_qc",
        "salinity_gradient_qc",
        "oxygen_gradient_qc",
    )


# --- A, E: windowed statistics --------------------------------------------------


@query("hourly_temperature")
def hourly_temperature(spark, sf_dir):
    return _hourly(spark, sf_dir, ["temp_avg", "temp_std", "temp_min", "temp_max", "measurement_count"]).drop(
        "data_quality"
    )


@query("hourly_salinity_density")
def hourly_salinity_density(spark, sf_dir):
    return _hourly(spark, sf_dir, ["salinity_avg", "salinity_std", "density_avg"])


@query("hourly_oxygen")
def hourly_oxygen(spark, sf_dir):
    return _hourly(spark, sf_dir, ["oxygen_avg", "oxygen_saturation_avg", "oxygen_min"])


@query("hourly_ph_deviation")
def hourly_ph_deviation(spark, sf_dir):
    return _hourly(spark, sf_dir, ["ph_avg", "ph_max_deviation"])


@query("ph_global_deviation")
def ph_global_deviation_q(spark, sf_dir):
    return rounded(ph_global_deviation(add_derived(FX.readings(spark, sf_dir))))


@query("hourly_turbidity_chlorophyll")
def hourly_turbidity_chlorophyll(spark, sf_dir):
    return _hourly(spark, sf_dir, ["turbidity_avg", "turbidity_max", "chlorophyll_avg", "chlorophyll_max"])


@query("hourly_current_circular")
def hourly_current_circular(spark, sf_dir):
    return _hourly(
        spark,
        sf_dir,
        ["current_speed_avg", "current_speed_max", "current_direction_sin_avg", "current_direction_cos_avg"],
    )


@query("qc_failure_counts")
def qc_failure_counts(spark, sf_dir):
    return _hourly(
        spark,
        sf_dir,
        ["temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures", "ph_qc_failures", "gradient_qc_failures"],
    ).drop("qc_score", "quality_category")


@query("temp_gradient_span")
def temp_gradient_span(spark, sf_dir):
    return _hourly(spark, sf_dir, ["temp_min", "temp_max", "min_depth", "max_depth"])


@query("data_quality_classes")
def data_quality_classes(spark, sf_dir):
    """E3 over 6-hour windows, where all three classes occur."""
    return _hourly(spark, sf_dir, ["measurement_count"], duration="6 hours")


@query("qc_score_categories")
def qc_score_categories(spark, sf_dir):
    out = _hourly(
        spark,
        sf_dir,
        ["temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures", "ph_qc_failures", "gradient_qc_failures"],
        duration="6 hours",
    )
    return out.select(*WINDOW_KEYS, "qc_score", "quality_category")


@query("ocean_metrics")
def ocean_metrics_q(spark, sf_dir):
    """Flagship: every statistic of §2.5 with E1-E5, hourly."""
    return _hourly(spark, sf_dir, None)


@query("ocean_metrics_location_profiles")
def ocean_metrics_location_profiles(spark, sf_dir):
    """The flagship with the original batch gradient semantics: one profile per
    location over all time (few, huge profiles; the skew-safe path)."""
    out = ocean_metrics_batch(FX.readings(spark, sf_dir), gradient_scope="location")
    return rounded(out)


# --- air quality ----------------------------------------------------------------


@query("air_quality_metrics")
def air_quality_metrics_q(spark, sf_dir):
    return rounded(air_quality_metrics(FX.air_readings(spark, sf_dir)))


def registry() -> dict[str, Query]:
    # Modules that register more queries on import.
    from thermocline.plans import catalog_sources  # noqa: F401
    from thermocline.plans import catalog_streams  # noqa: F401

    return dict(QUERIES)


__all__ = ["QUERIES", "query", "registry", "rounded"]
