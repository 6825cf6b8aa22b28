"""Hand-computed cases for the row-level expressions."""

from __future__ import annotations

import pytest
from core_shared import reading
from pyspark.sql import functions as F

from thermocline.functions.ocean import bounds_flag, depth_layer, density, oxygen_saturation
from thermocline.operators.derive import add_derived, parse_messages
from thermocline.operators.qc import CORE_BOUNDED, EXTRA_BOUNDED, add_bound_flags


def test_depth_layer_edges(spark):
    df = spark.createDataFrame([(10.0,), (10.01,), (100.0,), (1000.0,), (1000.01,), (None,), (0.0,)], "depth double")
    got = [r[0] for r in df.select(depth_layer()).collect()]
    assert got == ["surface", "mixed_layer", "mixed_layer", "mesopelagic", "deep_ocean", "deep_ocean", "surface"]


def test_density_and_saturation(spark):
    df = spark.createDataFrame([(35.0, 10.0, 7.0), (35.0, 36.5, 7.0)], "salinity double, temperature double, dissolved_oxygen double")
    rows = df.select(density().alias("d"), oxygen_saturation().alias("s")).collect()
    assert rows[0]["d"] == pytest.approx(1000 + 0.8 * 35 - 0.2 * 10)
    assert rows[0]["s"] == pytest.approx(7.0 / (14.6 - 0.4 * 10))
    # 14.6 - 0.4 * 36.5 is -1.8e-15 in doubles, not 0: the value is huge but
    # finite, exactly as the plain formula gives (no ANSI error either way).
    assert rows[1]["s"] == 7.0 / (14.6 - 0.4 * 36.5)


@pytest.mark.parametrize(
    "layer,temp,expected",
    [
        ("surface", 35.0, "pass"), ("surface", 35.01, "fail"), ("surface", -2.0, "pass"), ("surface", -2.01, "fail"),
        ("mixed_layer", 30.0, "pass"), ("mixed_layer", 30.5, "fail"),
        ("mesopelagic", 25.0, "pass"), ("mesopelagic", 25.5, "fail"),
        ("deep_ocean", 20.0, "pass"), ("deep_ocean", 20.5, "fail"),
        ("surface", None, "fail"),
    ],
)
def test_layered_temperature_bounds(spark, layer, temp, expected):
    df = spark.createDataFrame([(layer, temp)], "depth_layer string, temperature double")
    assert df.select(bounds_flag("temperature")).first()[0] == expected


def test_every_layer_has_its_own_bound(spark, make_readings):
    """The original only bounded the surface layer (array element 1); every layer
    must be checked against its own limits."""
    rows = [reading(depth=d, temperature=t, dissolved_oxygen=o) for d, t, o in
            [(5, 34.0, 11.0), (50, 29.0, 9.0), (500, 24.0, 7.0), (1500, 19.0, 5.0)]]
    out = add_bound_flags(add_derived(make_readings(rows)), CORE_BOUNDED).collect()
    assert {r["temp_qc_flag"] for r in out} == {"pass"}
    assert {r["oxygen_qc_flag"] for r in out} == {"pass"}


def test_fixed_and_extra_bounds(spark, make_readings):
    rows = [
        reading(salinity=28.0, ph=7.0, turbidity=50.0, current_speed=3.0, chlorophyll=50.0, depth=5),
        reading(salinity=41.01, ph=8.51, turbidity=50.01, current_speed=3.01, chlorophyll=1.01, depth=1500),
        reading(salinity=None, ph=None, turbidity=None, current_speed=None, chlorophyll=None),
    ]
    out = add_bound_flags(add_derived(make_readings(rows)), ["salinity", "ph", *EXTRA_BOUNDED]).collect()
    flags = ["salinity_qc_flag", "ph_qc_flag", "turbidity_qc_flag", "current_speed_qc_flag", "chlorophyll_qc_flag"]
    assert [out[0][f] for f in flags] == ["pass"] * 5
    assert [out[1][f] for f in flags] == ["fail"] * 5
    assert [out[2][f] for f in flags] == ["fail"] * 5  # NULL measurement fails


def test_parse_messages_bad_inputs(spark):
    raw = spark.createDataFrame(
        [('{"timestamp":"2024-01-01T00:10:00","location":"a","depth":5,"temperature":10}',),
         ('{"timestamp":"not a time","location":"a","depth":5,"temperature":10}',),
         ("{not json",)],
        "value string",
    )
    rows = parse_messages(raw.select(F.col("value").cast("binary").alias("value"))).collect()
    assert rows[0]["timestamp"] is not None and rows[0]["depth"] == 5.0
    assert rows[1]["timestamp"] is None  # unparsable time -> NULL, no ANSI error
    assert all(v is None for v in rows[2].asDict().values())  # malformed JSON -> all NULL
