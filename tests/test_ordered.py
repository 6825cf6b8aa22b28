"""The skew-safe successor operator against the plain window (brute force)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from thermocline.operators.ordered import large_groups, splitters, with_successor, with_successor_window
from thermocline.operators.qc import add_gradient_flags


def _skewed(spark, n=20000):
    # key "hot" holds about half of all rows; NULL keys and tied depths included.
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.lit("hot"))
        .when(F.col("id") % 97 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 37).cast("string")))
        .alias("location"),
        (F.col("id") % 10 == 0).alias("flag"),
        ((F.col("id") * 7919) % 500 / 10.0).alias("depth"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.sin(F.col("id").cast("double"))).alias("temperature"),
    )


@pytest.mark.parametrize("per", [20_000, 4_000, 400, 60])
def test_matches_window_under_skew(spark, per):
    df = _skewed(spark)
    keys, order, carry = ["location"], ["depth", "event_id"], ["depth", "temperature"]
    fast = with_successor(df, keys, order, carry, position_col="pos", rows_per_slice=per)
    slow = with_successor_window(df, keys, order, carry, position_col="pos")
    cols = ["event_id", "next_depth", "next_temperature", "pos"]
    a = sorted(tuple(r) for r in fast.select(*cols).collect())
    b = sorted(tuple(r) for r in slow.select(*cols).collect())
    assert len(a) == df.count()
    assert a == b


def test_large_groups_are_cut_evenly(spark):
    """The hot key is spread over slices of about the wanted size, and no other key is cut."""
    df = _skewed(spark)
    keys, order = ["location"], ["depth", "event_id"]
    table, sizes, per = large_groups(df, keys, 1000)
    assert sizes == [10000] and per == 1000 and table.first()["_tc_k0"] == "hot"
    cuts = splitters(df, keys, order, table, sizes, per)
    assert 7 <= len(cuts[0]) <= 10
    depth_of_cut = [float(c["o0"]) for c in cuts[0]]
    hot = sorted(((r.depth, r.event_id) for r in df.where("location = 'hot'").collect()))
    edges = [0, *[sum(d < (c["o0"], c["o1"]) for d in hot) for c in cuts[0]], len(hot)]
    assert depth_of_cut == sorted(depth_of_cut) and max(b - a for a, b in zip(edges, edges[1:], strict=False)) < 2 * per


def test_plan_has_one_row_shuffle(spark):
    df = _skewed(spark)
    for per in (100_000, 1000):
        plan = with_successor(df, ["location"], ["depth", "event_id"], ["depth"], rows_per_slice=per)._jdf.queryExecution().executedPlan().toString()
        rows = [x for x in plan.splitlines() if "Exchange hashpartitioning(location" in x]
        assert len(rows) == 1 and "rangepartitioning" not in plan


def test_multi_column_keys(spark):
    df = _skewed(spark).withColumn("hour", (F.col("event_id") % 3))
    keys, order, carry = ["hour", "location"], ["depth", "event_id"], ["temperature"]
    a = sorted(tuple(r) for r in with_successor(df, keys, order, carry, rows_per_slice=500).select("event_id", "next_temperature").collect())
    b = sorted(tuple(r) for r in with_successor_window(df, keys, order, carry).select("event_id", "next_temperature").collect())
    assert a == b


def test_gradient_edge_cases(spark, make_readings):
    from core_shared import reading

    rows = [
        reading(location="a", depth=10.0, temperature=20.0),
        reading(location="a", depth=10.0, temperature=5.0),  # equal depth -> NULL rate -> pass
        reading(location="a", depth=11.0, temperature=4.0),  # |4-5|/1 = 1.0 > 0.5 on previous row
        reading(location="a", depth=30.0, temperature=3.9),  # last row -> pass
    ]
    df = make_readings(rows)
    out = add_gradient_flags(df, keys=["location"], order=["depth", "event_id"], keep_neighbours=True)
    got = [r["temp_gradient_qc"] for r in out.orderBy("depth", "event_id").collect()]
    assert got == ["pass", "fail", "pass", "pass"]


def test_slices_are_bounded_in_number(spark, monkeypatch):
    from thermocline.operators import ordered

    monkeypatch.setattr(ordered, "MAX_SLICES", 8)
    table, sizes, per = large_groups(_skewed(spark), ["location"], 10)
    assert per >= 20000 // 8 - 1 and len(sizes) == 1


@pytest.mark.parametrize("null_id", [True, False])
def test_ties_do_not_depend_on_input_order(make_readings, null_id):
    from core_shared import reading

    from thermocline.plans.ocean_metrics import ocean_metrics_batch
    from thermocline.streaming.metrics_stream import ocean_metrics_from_readings

    rows = [
        reading(location="a", depth=5.0, temperature=10.0),
        reading(location="a", depth=5.0, temperature=20.0),
        reading(location="a", depth=6.0, temperature=20.1),
    ]
    got = set()
    for order in ([0, 1, 2], [1, 0, 2], [2, 1, 0]):
        df = make_readings([rows[k] for k in order], with_id=False)
        df = df.withColumn("event_id", F.lit(None).cast("long")) if null_id else df
        for metrics in (ocean_metrics_batch(df), ocean_metrics_from_readings(df), ocean_metrics_from_readings(df, gradient_scope="layer")):
            got |= {(r["gradient_qc_failures"], r["qc_score"]) for r in metrics.collect()}
    assert len(got) == 1


def test_empty_input(spark):
    df = _skewed(spark).limit(0)
    out = with_successor(df, ["location"], ["depth", "event_id"], ["depth"], position_col="pos", rows_per_slice=4)
    assert out.count() == 0 and "next_depth" in out.columns and "pos" in out.columns


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),  # key, NULL included
        st.one_of(st.none(), st.integers(0, 5).map(float)),  # depth with NULLs and ties
        st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),  # carried value
    ),
    min_size=0,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_rows, per=st.integers(1, 20))
def test_successor_property(spark, rows, per):
    data = [(i, k, d, v) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, location string, depth double, temperature double")
    keys, order, carry = ["location"], ["depth", "event_id"], ["depth", "temperature"]
    fast = with_successor(df, keys, order, carry, position_col="pos", rows_per_slice=per)
    slow = with_successor_window(df, keys, order, carry, position_col="pos")
    cols = ["event_id", "next_depth", "next_temperature", "pos"]
    assert sorted(map(tuple, fast.select(*cols).collect())) == sorted(map(tuple, slow.select(*cols).collect()))


_rows2 = st.lists(
    st.tuples(
        st.sampled_from([0, 1, None]),  # first key (e.g. hour)
        st.sampled_from(["a", "b", None]),  # second key (e.g. location)
        st.one_of(st.none(), st.integers(0, 3).map(float)),
        st.floats(-5, 5, allow_nan=False),
    ),
    min_size=1,
    max_size=50,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=_rows2, per=st.integers(1, 10))
def test_successor_property_two_keys(spark, rows, per):
    data = [(i, h, k, d, v) for i, (h, k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, hour int, location string, depth double, temperature double")
    keys, order, carry = ["hour", "location"], ["depth", "event_id"], ["temperature"]
    fast = with_successor(df, keys, order, carry, position_col="pos", rows_per_slice=per)
    slow = with_successor_window(df, keys, order, carry, position_col="pos")
    cols = ["event_id", "next_temperature", "pos"]
    assert sorted(map(tuple, fast.select(*cols).collect())) == sorted(map(tuple, slow.select(*cols).collect()))
