"""Q1-Q10 quality flags and W1-W3 profile neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from thermocline import thresholds as TH
from thermocline.functions.ocean import bounds_flag, gradient_flag
from thermocline.operators.ordered import with_successor

# The four range checks that feed qc_score, and the three extra ones.
CORE_BOUNDED = ["temperature", "salinity", "dissolved_oxygen", "ph"]
EXTRA_BOUNDED = ["turbidity", "chlorophyll", "current_speed"]

# Name of the "next value" column per measurement (the original names next_depth
# and next_temp are kept).
NEXT_NAMES = {
    "depth": "next_depth",
    "temperature": "next_temp",
    "salinity": "next_salinity",
    "dissolved_oxygen": "next_oxygen",
}

DEFAULT_ORDER = ("depth", "timestamp", "event_id")


def add_bound_flags(df: DataFrame, measurements: Sequence[str] = CORE_BOUNDED) -> DataFrame:
    """Q1-Q4 (and Q6-Q8 when asked): '<m>_qc_flag' = pass/fail per layer bounds.

    Needs ``depth_layer`` for the layered measurements (temperature, oxygen,
    chlorophyll).
    """
    return df.withColumns({TH.BOUND_FLAG_NAMES[m]: bounds_flag(m) for m in measurements})


def profile_order(df: DataFrame, order: Sequence[str] = DEFAULT_ORDER, carry: Sequence[str] = (), keys: Sequence[str] = ()) -> list[str]:
    """A total order of a profile's rows: ``order`` as far as the frame has it, then the carried values
    (as the streams' sorted arrays do), then every other column that can be ordered. Rows that tie on
    all of these are equal, so the result does not depend on the order of the input."""
    first = [c for c in dict.fromkeys([*order, *carry]) if c in df.columns]
    rest = sorted(f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType))
    return first + [c for c in rest if c not in first and c not in keys]


def add_profile_neighbours(
    df: DataFrame,
    keys: Sequence[str] = ("location",),
    order: Sequence[str] = DEFAULT_ORDER,
    measurements: Sequence[str] = ("temperature",),
    position_col: str | None = None,
) -> DataFrame:
    """next_depth and next_<measurement> along each profile, optionally the
    1-based ``position_col`` (the original ``depth_ordered``).

    A profile is all readings with equal ``keys``, ordered by depth, then time, then event id,
    then the other columns (``profile_order``). Profiles of every size take the same path, which
    spreads them over slices (see ``operators.ordered``).
    """
    carry = ["depth", *measurements]
    names = {c: NEXT_NAMES.get(c, f"next_{c}") for c in carry}
    return with_successor(df, keys, profile_order(df, order, carry, keys), carry, names=names, position_col=position_col)


def add_gradient_flags(
    df: DataFrame,
    keys: Sequence[str] = ("location",),
    order: Sequence[str] = DEFAULT_ORDER,
    measurements: Sequence[str] = ("temperature",),
    keep_neighbours: bool = False,
) -> DataFrame:
    """Q5 (and Q9, Q10 for salinity and oxygen): |d value| / d depth above the
    limit -> 'fail'; equal depths and a profile's last row -> 'pass'."""
    with_next = add_profile_neighbours(df, keys, order, measurements)
    flags = {}
    for m in measurements:
        flag_name, limit = TH.GRADIENT_LIMITS[m]
        flags[flag_name] = gradient_flag(
            F.col(m), F.col(NEXT_NAMES[m]), F.col("depth"), F.col("next_depth"), limit
        )
    out = with_next.withColumns(flags)
    if not keep_neighbours:
        out = out.drop("next_depth", *[NEXT_NAMES[m] for m in measurements])
    return out
