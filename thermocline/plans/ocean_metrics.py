"""The batch metrics plan: readings -> derive -> QC -> gradient -> aggregate -> enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.functions.ocean import depth_layer, is_fail
from thermocline.operators.derive import add_derived
from thermocline.operators.enrich import enrich_metrics
from thermocline.operators.metrics import ALL_METRICS, ocean_metrics
from thermocline.operators.qc import CORE_BOUNDED, add_bound_flags, add_gradient_flags

PROFILE_WINDOW = "_profile_window"


def profile_keys(scope: str) -> list[str]:
    """Which readings form one vertical profile for the gradient check.

    "profile": all readings of a location inside one time window (pairs may cross
    depth layers, as in the original, but not windows); "layer": additionally
    within one depth layer (what a stream can compute in one stateful step);
    "location": the original batch form, all times of a location together.
    """
    if scope == "profile":
        return [PROFILE_WINDOW, "location"]
    if scope == "layer":
        return [PROFILE_WINDOW, "location", "depth_layer"]
    if scope == "location":
        return ["location"]
    raise ValueError(f"unknown gradient scope {scope!r}")


def flag_readings(
    readings: DataFrame,
    duration: str = TH.WINDOW_DURATION,
    gradient_scope: str = "profile",
    bounded: Sequence[str] = CORE_BOUNDED,
    gradients: Sequence[str] = ("temperature",),
    keep_neighbours: bool = False,
    keep_window: bool = False,
) -> DataFrame:
    """Row level: derived quantities, range flags and gradient flags. With
    ``keep_window`` the profile's window-start column is kept (as
    ``_profile_window``) so a following aggregate can reuse its partitioning."""
    df = add_bound_flags(add_derived(readings), bounded)
    if not gradients:
        return df
    df = df.withColumn(PROFILE_WINDOW, F.window("timestamp", duration).start)
    df = add_gradient_flags(
        df,
        keys=profile_keys(gradient_scope),
        measurements=gradients,
        keep_neighbours=keep_neighbours,
    )
    return df if keep_window else df.drop(PROFILE_WINDOW)


def gradient_failure_counts(
    readings: DataFrame,
    duration: str = TH.WINDOW_DURATION,
    gradient_scope: str = "profile",
) -> DataFrame:
    """A28 on its own: per (window, location, depth_layer), the number of rows
    whose temperature gradient to the next reading of their profile fails.

    Only the columns the check needs (time, location, depth, temperature, id)
    go through the profile shuffle, instead of every column the statistics use.
    """
    narrow = [c for c in ("timestamp", "location", "depth", "temperature", "event_id") if c in readings.columns]
    df = readings.select(*narrow).withColumns(
        {"depth_layer": depth_layer(), PROFILE_WINDOW: F.window("timestamp", duration).start}
    )
    df = add_gradient_flags(df, keys=profile_keys(gradient_scope))
    counted = df.filter(F.col(PROFILE_WINDOW).isNotNull()).groupBy(PROFILE_WINDOW, "location", "depth_layer")
    counted = counted.agg(F.sum(is_fail("temp_gradient_qc")).cast("bigint").alias("gradient_qc_failures"))
    return counted.select(
        F.col(PROFILE_WINDOW).cast("timestamp_ntz").alias("window_start"), "location", "depth_layer",
        "gradient_qc_failures",
    )


def ocean_metrics_batch(
    readings: DataFrame,
    duration: str = TH.WINDOW_DURATION,
    metrics: Sequence[str] | None = None,
    gradient_scope: str = "profile",
    enrich: bool = True,
    narrow_gradient: bool = True,
) -> DataFrame:
    """Per (window, location, depth_layer): the statistics of §2.5 plus E1-E5.

    Statistics are partial + final hash aggregates: only partial results move.
    The gradient check needs each profile's rows in order, i.e. a shuffle of
    rows; with ``narrow_gradient`` (default) that shuffle carries only the
    columns the check reads and its per-group counts are joined to the
    statistics (aggregated rows on both sides). Otherwise the flags are computed
    on the full rows and the aggregate reuses the profile shuffle (one shuffle,
    but of every column).
    """
    metrics = list(metrics or ALL_METRICS)
    want_gradient = "gradient_qc_failures" in metrics
    if want_gradient and narrow_gradient:
        # the groups themselves come from the statistics side (a count if nothing else is asked)
        others = [m for m in metrics if m != "gradient_qc_failures"] or ["measurement_count"]
        stats = ocean_metrics(flag_readings(readings, duration, gradients=()), duration, others)
        counts = gradient_failure_counts(readings, duration, gradient_scope)
        same_group = [
            stats["window_start"] == counts["window_start"],
            stats["location"].eqNullSafe(counts["location"]),
            stats["depth_layer"] == counts["depth_layer"],
        ]
        failures = F.coalesce(counts["gradient_qc_failures"], F.lit(0).cast("bigint")).alias("gradient_qc_failures")
        joined = stats.join(counts, same_group, "left").select(*[stats[c] for c in stats.columns], failures)
        out = joined.select("window_start", "window_end", "location", "depth_layer", *metrics)
    else:
        gradients = ("temperature",) if want_gradient else ()
        flagged = flag_readings(
            readings, duration, gradient_scope, gradients=gradients, keep_window=bool(gradients)
        )
        out = ocean_metrics(flagged, duration, metrics, window_start_col=PROFILE_WINDOW if gradients else None)
    return enrich_metrics(out) if enrich else out
