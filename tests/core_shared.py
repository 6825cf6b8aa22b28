"""Constants and row builders of the core tests (a module of its own name: each test folder has a conftest)."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

READING_DDL = (
    "timestamp timestamp, location string, depth double, temperature double, salinity double, "
    "dissolved_oxygen double, ph double, turbidity double, chlorophyll double, current_speed double, "
    "current_direction double"
)


def reading(ts="2024-01-01 00:10:00", location="a", depth=5.0, temperature=10.0, salinity=35.0,
            dissolved_oxygen=7.0, ph=8.0, turbidity=1.0, chlorophyll=1.0, current_speed=0.5,
            current_direction=90.0):
    import datetime as dt

    t = dt.datetime.fromisoformat(ts) if isinstance(ts, str) else ts
    nums = [depth, temperature, salinity, dissolved_oxygen, ph, turbidity, chlorophyll, current_speed,
            current_direction]
    return (t, location, *[None if v is None else float(v) for v in nums])
