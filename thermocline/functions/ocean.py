"""Column expressions for derived quantities and range checks.

All of them are built-in Spark expressions (no Python UDFs), so they stay inside
whole-stage codegen. Divisions use ``try_divide`` because ANSI mode is on by
default in Spark 4 and a plain ``/`` by zero raises instead of giving NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermocline import thresholds as TH


def col_of(c: str | Column) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(c) if isinstance(c, str) else c


def depth_layer(depth: str | Column = "depth") -> Column:
    """surface (<=10 m), mixed_layer (<=100), mesopelagic (<=1000), else deep_ocean."""
    d = col_of(depth)
    expr = None
    for name, edge in TH.LAYER_EDGES:
        expr = F.when(d <= F.lit(edge), F.lit(name)) if expr is None else expr.when(d <= F.lit(edge), F.lit(name))
    return expr.otherwise(F.lit(TH.DEEPEST_LAYER))


def density(salinity: str | Column = "salinity", temperature: str | Column = "temperature") -> Column:
    """Simplified sea-water density, kg/m3."""
    return (
        F.lit(TH.DENSITY_BASE)
        + F.lit(TH.DENSITY_SALINITY) * col_of(salinity)
        - F.lit(TH.DENSITY_TEMPERATURE) * col_of(temperature)
    )


def oxygen_saturation(
    dissolved_oxygen: str | Column = "dissolved_oxygen", temperature: str | Column = "temperature"
) -> Column:
    """DO / (14.6 - 0.4 T); NULL where the denominator is zero (T = 36.5)."""
    return F.try_divide(
        col_of(dissolved_oxygen), F.lit(TH.O2_SAT_BASE) - F.lit(TH.O2_SAT_TEMPERATURE) * col_of(temperature)
    )


def _bound(limits: dict, side: int, layer: Column) -> Column:
    if "*" in limits:
        return F.lit(limits["*"][side])
    expr = None
    for name, pair in limits.items():
        cond = layer == F.lit(name)
        expr = F.when(cond, F.lit(pair[side])) if expr is None else expr.when(cond, F.lit(pair[side]))
    return expr  # unknown layer -> NULL -> "fail"


def bounds_flag(measurement: str, layer: str | Column = "depth_layer", limits: dict | None = None) -> Column:
    """'pass' when the value lies inside its (per-layer) inclusive range, else 'fail'.

    A NULL value, or a layer without limits, is a 'fail' (the predicate is NULL).
    """
    limits = TH.BOUNDS[measurement] if limits is None else limits
    lyr = col_of(layer)
    v = F.col(measurement)
    inside = v.between(_bound(limits, 0, lyr), _bound(limits, 1, lyr))
    return F.when(inside, F.lit("pass")).otherwise(F.lit("fail"))


def gradient_flag(value: Column, next_value: Column, depth: Column, next_depth: Column, limit: float) -> Column:
    """'fail' when |next - this| / (next_depth - depth) exceeds ``limit``.

    Equal depths (division by zero) and the last row of a profile (no next row)
    give NULL, which is a 'pass'.
    """
    rate = F.try_divide(F.abs(next_value - value), next_depth - depth)
    return F.when(rate > F.lit(limit), F.lit("fail")).otherwise(F.lit("pass"))


def is_fail(flag: str | Column) -> Column:
    """1 for a 'fail' flag, else 0 (as the reference's sum(when(...,1).otherwise(0)))."""
    return F.when(col_of(flag) == F.lit("fail"), F.lit(1)).otherwise(F.lit(0))


def circular_mean_degrees(sin_avg: str | Column, cos_avg: str | Column) -> Column:
    """Mean direction in (-180, 180] from averaged unit-vector components."""
    return F.degrees(F.atan2(col_of(sin_avg), col_of(cos_avg)))


def compass_degrees(direction: str | Column) -> Column:
    """A direction in (-180, 180] as a compass bearing in [0, 360)."""
    return F.pmod(col_of(direction), F.lit(360.0))


def classify(value: Column, classes: list[tuple[str, float]], default: str) -> Column:
    """First class whose lower edge the value reaches, else ``default``."""
    expr = None
    for name, edge in classes:
        cond = value >= F.lit(edge)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))
