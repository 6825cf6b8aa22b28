"""W4 on a stream: gradient failures of a profile from mergeable summaries.

The gradient check compares each reading with the next deeper one of its profile. A window
function over the profile is refused on streams, and gathering a profile's readings would put
all rows of a hot station into one task and one state entry. Instead, readings are summed up
in chained aggregations, each of which holds a bounded summary a group:

1. ``by_depth``, per (window, location, layer, depth): the first and the last reading at that depth, as
   the least and greatest (time, id, temperature). Readings of one depth never fail among
   themselves (equal depths are a pass), so a depth needs no more, however many rows it has.
2. ``by_bucket``, per BUCKET_METRES of a layer: the failures between neighbouring depths of the
   bucket, its first and its last depth. The group holds the distinct depths within one bucket.
3. ``by_profile``, per (window, location): the failures between neighbouring buckets, counted where the
   shallower reading is. The group holds a summary a bucket: at most depth / BUCKET_METRES of them.
4. ``by_layer``: the statistics of each (window, location, layer).

The statistics (sums with counts, extremes, and count, mean and squared deviations for the
standard deviations) travel with the summaries and are merged at each step. In batch the same
functions apply; ``operators.ordered`` is the shorter way there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.functions.ocean import is_fail
from thermocline.operators.metrics import ALL_METRICS, window_bounds

#: Depth range of one bucket; the deepest sea has 11,000 of them.
BUCKET_METRES = 1.0

#: Averaged value -> output name.
_MEANS = {
    "temp_avg": "temperature", "salinity_avg": "salinity", "density_avg": "density", "oxygen_avg": "dissolved_oxygen",
    "oxygen_saturation_avg": "oxygen_saturation", "ph_avg": "ph", "turbidity_avg": "turbidity", "chlorophyll_avg": "chlorophyll",
    "current_speed_avg": "current_speed", "current_direction_sin_avg": "_sin", "current_direction_cos_avg": "_cos",
}
_DEVIATIONS = {"temp_std": "temperature", "salinity_std": "salinity"}
_LEAST = {"temp_min": "temperature", "oxygen_min": "dissolved_oxygen", "_ph_min": "ph", "min_depth": "depth"}
_GREATEST = {"temp_max": "temperature", "_ph_max": "ph", "turbidity_max": "turbidity", "chlorophyll_max": "chlorophyll", "current_speed_max": "current_speed", "max_depth": "depth"}
_FAILURES = {"temp_qc_failures": "temp_qc_flag", "salinity_qc_failures": "salinity_qc_flag", "oxygen_qc_failures": "oxygen_qc_flag", "ph_qc_failures": "ph_qc_flag"}
_COUNTS = ["measurement_count", *_FAILURES, "gradient_qc_failures"]

_SUMS = [f"_sum_{m}" for m in _MEANS] + [f"_n_{m}" for m in _MEANS] + _COUNTS
_ENDS = ["_first_depth", "_first_temp", "_last_depth", "_last_temp"]


def _squared_deviations(measure: str) -> Column:
    return F.coalesce(F.var_pop(measure) * F.count(measure), F.lit(0.0))


def _from_rows() -> list[Column]:
    """Partial statistics of a group of readings."""
    return [
        *[F.sum(v).alias(f"_sum_{m}") for m, v in _MEANS.items()],
        *[F.count(v).alias(f"_n_{m}") for m, v in _MEANS.items()],
        *[_squared_deviations(v).alias(f"_m2_{m}") for m, v in _DEVIATIONS.items()],
        *[F.min(v).alias(m) for m, v in _LEAST.items()],
        *[F.max(v).alias(m) for m, v in _GREATEST.items()],
        *[F.sum(is_fail(f)).cast("bigint").alias(m) for m, f in _FAILURES.items()],
        F.count(F.lit(1)).alias("measurement_count"),
    ]


def _moments(m: str) -> list[str]:
    """Names of sum, count and squared deviations of the value behind a standard deviation."""
    mean = {"temp_std": "temp_avg", "salinity_std": "salinity_avg"}[m]
    return [f"_sum_{mean}", f"_n_{mean}", f"_m2_{m}"]


def _merged() -> list[Column]:
    """Partial statistics of a group of partial statistics; what belongs to deviations is gathered, a part each."""
    return [
        *[F.sum(c).alias(c) for c in _SUMS],
        *[F.min(c).alias(c) for c in _LEAST],
        *[F.max(c).alias(c) for c in _GREATEST],
        *[F.collect_list(F.struct(*[F.col(c).alias(n) for c, n in zip(_moments(m), ("s", "n", "m2"), strict=True)])).alias(f"_m2_{m}") for m in _DEVIATIONS],
    ]


def _total_deviation(parts: str) -> Column:
    """Squared deviations of parts (sum, count, squared deviations) together, merged two by two."""

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = F.try_divide(b["s"], b["n"].cast("double")) - F.try_divide(a["s"], a["n"].cast("double"))
        between = F.coalesce(apart * apart * F.try_divide((a["n"] * b["n"]).cast("double"), n.cast("double")), F.lit(0.0))
        return F.struct((F.coalesce(a["s"], F.lit(0.0)) + F.coalesce(b["s"], F.lit(0.0))).alias("s"), n.alias("n"), (a["m2"] + b["m2"] + between).alias("m2"))

    none = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(parts), none, merge, lambda a: a["m2"])


def _gradient_fails(last_depth: Column, last_temp: Column, next_depth: Column, next_temp: Column) -> Column:
    _, limit = TH.GRADIENT_LIMITS["temperature"]
    rate = F.try_divide(F.abs(next_temp - last_temp), next_depth - last_depth)
    return F.coalesce(rate > F.lit(limit), F.lit(False))


def by_depth(flagged: DataFrame, duration: str) -> DataFrame:
    """Step 1 over flagged readings; event times stay on the windows."""
    order = [c for c in ("timestamp", "event_id", "temperature") if c in flagged.columns]
    unit = {"_sin": F.sin(F.radians("current_direction")), "_cos": F.cos(F.radians("current_direction"))}
    # NaN sorts behind all depths and floors to 0, so it gets a bucket of its own
    bucket = F.when(F.isnan("depth"), F.lit(1 << 62)).otherwise(F.floor(F.col("depth") / BUCKET_METRES))
    keyed = flagged.withColumns(unit | {"_bucket": bucket, "_depth": F.col("depth")})
    reading = F.struct(*order)
    summed = keyed.groupBy(F.window("timestamp", duration).alias("w"), "location", "depth_layer", "_bucket", "_depth").agg(
        *_from_rows(), F.min(reading)["temperature"].alias("_first_temp"), F.max(reading)["temperature"].alias("_last_temp")
    )
    return summed.withColumns({"_first_depth": F.col("_depth"), "_last_depth": F.col("_depth"), "gradient_qc_failures": F.lit(0).cast("bigint")}).drop("_depth")


def _again(df: DataFrame, duration: str) -> Column:
    return F.window(F.window_time("w"), duration).alias("w")


def _sorted_run(fields: list[str]) -> Column:
    """The group's parts as an array in depth order."""
    return F.array_sort(F.collect_list(F.struct(*fields)))


def by_bucket(parts: DataFrame, duration: str) -> DataFrame:
    """Step 2: one row for each bucket of a layer."""
    merged = parts.groupBy(_again(parts, duration), "location", "depth_layer", "_bucket").agg(*_merged(), _sorted_run(_ENDS).alias("_run"))
    inner = _failures_along(F.col("_run"))
    first, last = F.element_at("_run", 1), F.element_at("_run", -1)
    ends = {"_first_depth": first["_first_depth"], "_first_temp": first["_first_temp"], "_last_depth": last["_last_depth"], "_last_temp": last["_last_temp"]}
    deviations = {f"_m2_{m}": _total_deviation(f"_m2_{m}") for m in _DEVIATIONS}
    return merged.withColumns(ends | deviations | {"gradient_qc_failures": F.col("gradient_qc_failures") + inner}).drop("_run", "_bucket")


def _failures_along(run: Column) -> Column:
    """Failures between neighbours of a sorted run."""
    n = F.size(run)
    fails = F.zip_with(F.slice(run, F.lit(1), n - 1), F.slice(run, F.lit(2), n - 1), _between)
    return F.size(F.filter(fails, lambda f: f)).cast("bigint")


def _between(a: Column, b: Column) -> Column:
    return _gradient_fails(a["_last_depth"], a["_last_temp"], b["_first_depth"], b["_first_temp"])


def by_profile(buckets: DataFrame, duration: str) -> DataFrame:
    """Step 3: the buckets again, with the failures towards the next bucket of the profile."""
    rest = [c for c in buckets.columns if c not in ("w", "location", *_ENDS)]
    grouped = buckets.groupBy(_again(buckets, duration), "location").agg(_sorted_run([*_ENDS, *rest]).alias("_run"))

    def follow(x: Column, i: Column) -> Column:
        across = F.coalesce(_between(x, F.get(F.col("_run"), i + 1)), F.lit(False)).cast("bigint")
        own = [(x[c] + across if c == "gradient_qc_failures" else x[c]).alias(c) for c in rest]
        return F.struct(*own)

    return grouped.select("w", "location", F.explode(F.transform("_run", follow)).alias("_p")).select("w", "location", "_p.*")


def by_layer(parts: DataFrame, duration: str, pairs: bool) -> DataFrame:
    """Step 4: window_start, window_end, location, depth_layer and all statistics. With ``pairs``, buckets are paired
    here, within their layer (there is no step 3)."""
    run = [_sorted_run(_ENDS).alias("_run")] if pairs else []
    merged = parts.groupBy(_again(parts, duration), "location", "depth_layer").agg(*_merged(), *run)
    mean = lambda m: F.try_divide(F.col(f"_sum_{m}"), F.col(f"_n_{m}").cast("double"))
    out = {m: mean(m) for m in _MEANS}
    for m in _DEVIATIONS:
        n = F.col(_moments(m)[1])
        out[m] = F.when(n > 1, F.sqrt(_total_deviation(f"_m2_{m}") / (n - 1).cast("double")))
    out["ph_max_deviation"] = F.greatest(F.col("_ph_max") - mean("ph_avg"), mean("ph_avg") - F.col("_ph_min"))
    if pairs:
        out["gradient_qc_failures"] = F.col("gradient_qc_failures") + _failures_along(F.col("_run"))
    return merged.withColumns(out).select(*window_bounds("w"), "location", "depth_layer", *ALL_METRICS)


def summarised_metrics(flagged: DataFrame, duration: str = TH.WINDOW_DURATION, scope: str = "profile") -> DataFrame:
    """All statistics per (window, location, depth_layer) of flagged readings, stream or batch. ``scope`` is "profile"
    (pairs across the layers of a window and location) or "layer" (pairs within a layer)."""
    buckets = by_bucket(by_depth(flagged, duration), duration)
    if scope == "layer":
        return by_layer(buckets, duration, pairs=True)
    if scope == "profile":
        return by_layer(by_profile(buckets, duration), duration, pairs=False)
    raise ValueError(f"scope must be layer or profile, not {scope!r}")
