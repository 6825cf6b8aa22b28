"""Hand-computed aggregates and properties."""

from __future__ import annotations

import pytest
from core_shared import MEDIUM, reading
from pyspark.sql import Window
from pyspark.sql import functions as F

from thermocline import fixtures as FX
from thermocline.operators.derive import add_derived
from thermocline.operators.metrics import ph_global_deviation
from thermocline.plans.ocean_metrics import ocean_metrics_batch


def test_single_row_group(spark, make_readings):
    out = ocean_metrics_batch(make_readings([reading()])).first()
    assert out["measurement_count"] == 1
    assert out["temp_std"] is None  # sample stddev of one value
    assert out["temp_gradient"] is None  # zero depth span
    assert out["data_quality"] == "low"


def test_circular_mean_wraps(spark, make_readings):
    rows = [reading(current_direction=350.0), reading(current_direction=10.0, ts="2024-01-01 00:20:00")]
    out = ocean_metrics_batch(make_readings(rows)).first()
    assert out["current_direction_avg"] == pytest.approx(0.0, abs=1e-9)
    west = [reading(current_direction=260.0), reading(current_direction=270.0, ts="2024-01-01 00:20:00")]
    out = ocean_metrics_batch(make_readings(west)).first()
    assert out["current_direction_avg"] == pytest.approx(-95.0)  # signed, as the original
    assert out["current_direction_compass"] == pytest.approx(265.0)


@pytest.mark.parametrize("fails,score,category", [(0, 100, "excellent"), (1, 95, "excellent"), (3, 85, "good"),
                                                   (5, 75, "fair"), (6, 70, "poor")])
def test_qc_score(spark, make_readings, fails, score, category):
    # each bad row fails salinity only (37 is fine for temperature/oxygen/pH at 5 m)
    rows = [reading(salinity=50.0 if i < fails else 35.0, depth=5.0 + i * 0.001, ts=f"2024-01-01 00:{10 + i}:00")
            for i in range(8)]
    out = ocean_metrics_batch(make_readings(rows)).first()
    assert out["salinity_qc_failures"] == fails
    assert out["qc_score"] == score and out["quality_category"] == category


def test_counts_add_up_and_ph_identity(spark):
    r = FX.readings(spark, MEDIUM)
    m = ocean_metrics_batch(r)
    assert m.agg(F.sum("measurement_count")).first()[0] == r.count()
    # D3: one-pass max deviation equals the two-pass max |ph - group mean|
    d = add_derived(r).withColumn("w", F.window("timestamp", "1 hour").start)
    g = Window.partitionBy("w", "location", "depth_layer")
    two_pass = d.withColumn("dev", F.abs(F.col("ph") - F.avg("ph").over(g))).groupBy(
        F.col("w").cast("timestamp_ntz").alias("window_start"), "location", "depth_layer"
    ).agg(F.max("dev").alias("two"))
    j = m.join(two_pass, ["window_start", "location", "depth_layer"])
    assert j.filter(F.abs(F.col("ph_max_deviation") - F.col("two")) > 1e-9).count() == 0
    assert j.count() == m.count()


def test_qc_score_formula_holds(spark):
    m = ocean_metrics_batch(FX.readings(spark, MEDIUM))
    total = sum(F.col(c) for c in ["temp_qc_failures", "salinity_qc_failures", "oxygen_qc_failures",
                                    "ph_qc_failures", "gradient_qc_failures"])
    assert m.filter(F.col("qc_score") != F.lit(100) - total * 5).count() == 0


def test_global_ph_deviation(spark, make_readings):
    rows = [reading(ph=7.0), reading(ph=8.0, location="b"), reading(ph=9.0, location="b", ts="2024-01-01 00:30:00")]
    out = {r["location"]: r for r in ph_global_deviation(add_derived(make_readings(rows))).collect()}
    assert out["a"]["ph_global_mean"] == pytest.approx(8.0)
    assert out["a"]["ph_max_global_deviation"] == pytest.approx(1.0)
    assert out["b"]["ph_max_global_deviation"] == pytest.approx(1.0)


@pytest.mark.parametrize("scope,keys", [("location", ["location"]), ("layer", ["w", "location", "depth_layer"])])
def test_gradient_scopes_match_brute_force(spark, scope, keys):
    from core_shared import SMALL
    from pyspark.sql import Window as W

    r = FX.readings(spark, SMALL)
    got = ocean_metrics_batch(r, gradient_scope=scope, metrics=["gradient_qc_failures"])
    d = add_derived(r).withColumn("w", F.window("timestamp", "1 hour").start)
    w = W.partitionBy(*keys).orderBy("depth", "timestamp", "event_id")
    rate = F.try_divide(
        F.abs(F.lead("temperature").over(w) - F.col("temperature")), F.lead("depth").over(w) - F.col("depth")
    )
    brute = (
        d.withColumn("fail", F.when(rate > 0.5, 1).otherwise(0))
        .groupBy(F.col("w").cast("timestamp_ntz").alias("window_start"), "location", "depth_layer")
        .agg(F.sum("fail").cast("bigint").alias("gradient_qc_failures"))
    )
    cols = ["window_start", "location", "depth_layer", "gradient_qc_failures"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, brute.select(*cols).collect()))


def test_narrow_gradient_equals_wide(spark):
    r = FX.readings(spark, MEDIUM)
    narrow = ocean_metrics_batch(r, narrow_gradient=True)
    wide = ocean_metrics_batch(r, narrow_gradient=False)
    assert narrow.columns == wide.columns
    from thermocline.plans.catalog import rounded

    assert sorted(map(tuple, rounded(narrow).collect())) == sorted(map(tuple, rounded(wide).collect()))
