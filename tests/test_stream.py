"""Batch = stream on closed windows; late rows ignored; restart adds nothing."""

from __future__ import annotations

import json

import pytest
from core_shared import SMALL
from pyspark.sql import functions as F

from thermocline import feed_fixtures as FF
from thermocline import fixtures as FX
from thermocline.plans.catalog import rounded
from thermocline.plans.ocean_metrics import ocean_metrics_batch
from thermocline.sources.messages import read_message_stream
from thermocline.streaming.metrics_stream import ocean_metrics_from_messages, start_append_stream


def _run(spark, inp, out, chk):
    q = start_append_stream(
        ocean_metrics_from_messages(read_message_stream(spark, "text", path=inp), gradient_scope="layer"), out, chk,
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    return spark.read.parquet(out).drop("window_date")


def _rows(df):
    return sorted(tuple(r) for r in rounded(df).collect())


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    inp = str(tmp_path / "in")
    FF.reading_messages(spark, SMALL).write.text(inp)
    streamed = _run(spark, inp, str(tmp_path / "out"), str(tmp_path / "chk"))
    r = FX.readings(spark, SMALL)
    cutoff = r.agg(F.max("timestamp")).first()[0]
    batch = ocean_metrics_batch(r, gradient_scope="layer").filter(
        F.col("window_end") <= F.lit(cutoff).cast("timestamp_ntz") - F.expr("INTERVAL 15 MINUTES")
    )
    assert streamed.count() > 0
    assert _rows(streamed.select(*batch.columns)) == _rows(batch)


def test_late_row_ignored_and_restart_idempotent(spark, tmp_path):
    inp, out, chk = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "chk")
    inp.mkdir()

    def msg(ts, t):
        return json.dumps({"timestamp": ts, "location": "a", "depth": 5.0, "temperature": t, "salinity": 35.0})

    (inp / "1.json").write_text("\n".join([msg("2024-01-01T00:10:00", 10.0), msg("2024-01-01T02:00:00", 11.0)]))
    first = _run(spark, str(inp), out, chk)
    assert first.count() == 1  # only 00:00-01:00 is closed (watermark 01:45)
    # a row for the closed hour arrives late, plus one that advances time
    (inp / "2.json").write_text("\n".join([msg("2024-01-01T00:20:00", 99.0), msg("2024-01-01T05:00:00", 12.0)]))
    second = _run(spark, str(inp), out, chk)
    rows = {r["window_start"].hour: r for r in second.collect()}
    assert rows[0]["measurement_count"] == 1 and rows[0]["temp_max"] == 10.0  # late row dropped
    assert sorted(rows) == [0, 2]  # 02:00 closed now; 05:00 still open
    third = _run(spark, str(inp), out, chk)  # restart with nothing new
    assert third.count() == second.count()


def test_profile_scope_stream_equals_batch(spark, tmp_path):
    inp = str(tmp_path / "in")
    FF.reading_messages(spark, SMALL).write.text(inp)
    q = start_append_stream(
        ocean_metrics_from_messages(read_message_stream(spark, "text", path=inp), gradient_scope="profile"),
        str(tmp_path / "out"), str(tmp_path / "chk"), trigger={"availableNow": True},
    )
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).drop("window_date")
    r = FX.readings(spark, SMALL)
    cutoff = r.agg(F.max("timestamp")).first()[0]
    batch = ocean_metrics_batch(r, gradient_scope="profile").filter(
        F.col("window_end") <= F.lit(cutoff).cast("timestamp_ntz") - F.expr("INTERVAL 15 MINUTES")
    )
    assert _rows(streamed.select(*batch.columns)) == _rows(batch)


def test_metrics_table_round_trip_and_model(spark, tmp_path):
    from thermocline.plans.pipeline import run_pipeline

    metrics, model, preds, evaluation = run_pipeline(FX.readings(spark, SMALL), metrics_path=str(tmp_path / "m"))
    assert metrics.count() == spark.read.parquet(str(tmp_path / "m")).count() > 0
    assert preds.count() == metrics.count()  # every row predicted (no NULL features here)
    assert set(evaluation) == {"rmse", "r2"} and evaluation["rmse"] >= 0


def test_staged_stream_late_rows_and_replay(spark, tmp_path):
    import datetime as dt

    from thermocline.streaming.staged_stream import (
        process_batch,
        read_late_rows,
        read_progress,
        read_rejects,
        read_staged_metrics,
        start_staged_metrics_stream,
    )

    inp, stage, out, chk = tmp_path / "in", str(tmp_path / "stage"), str(tmp_path / "out"), str(tmp_path / "chk")
    inp.mkdir()

    def msg(ts, t):
        return json.dumps({"timestamp": ts, "location": "a", "depth": 5.0, "temperature": t, "salinity": 35.0})

    def run():
        q = start_staged_metrics_stream(
            read_message_stream(spark, "text", path=str(inp)), stage, out, chk, trigger={"availableNow": True}
        )
        q.awaitTermination()
        return read_staged_metrics(spark, out)

    (inp / "1.json").write_text("\n".join([msg("2024-01-01T00:10:00", 10.0), msg("2024-01-01T02:00:00", 11.0)]))
    assert run().count() == 1
    (inp / "2.json").write_text("\n".join([msg("2024-01-01T00:20:00", 99.0), msg("2024-01-01T05:00:00", 12.0)]))
    rows = {r["window_start"].hour: r for r in run().collect()}
    assert sorted(rows) == [0, 2] and rows[0]["measurement_count"] == 1 and rows[0]["temp_max"] == 10.0
    assert run().count() == 2  # restart with nothing new
    progress = [tuple(r)[2:] for r in read_progress(spark, stage).orderBy("batch").collect()]
    assert progress == [(2, 0, 0), (2, 1, 0)]
    assert [(r["batch"], r["temperature"]) for r in read_late_rows(spark, stage).collect()] == [(1, 99.0)]
    assert read_rejects(spark, stage).collect() == []

    # replaying a batch id rewrites the same partitions: no duplicates
    ddl = "timestamp timestamp, location string, depth double, temperature double, salinity double"
    replay = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9, 0), "a", 5.0, 13.0, 35.0)], ddl)
    for _ in range(2):
        process_batch(replay, 7, stage, out)
    got = read_staged_metrics(spark, out)
    assert got.count() == 3 and got.filter("hour(window_start) = 5").count() == 1


def test_bad_messages_dropped_at_windowing(spark, tmp_path):
    inp, out, chk = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "chk")
    inp.mkdir()
    good = [json.dumps({"timestamp": f"2024-01-01T0{h}:10:00", "location": "a", "depth": 5.0, "temperature": 10.0,
                        "salinity": 35.0}) for h in range(3)]
    bad = ["{not json", json.dumps({"timestamp": "yesterday", "location": "a", "depth": 5.0, "temperature": 99.0})]
    (inp / "m.json").write_text("\n".join(good + bad))
    got = _run(spark, str(inp), out, chk)
    rows = sorted((r["window_start"].hour, r["measurement_count"], r["temp_max"]) for r in got.collect())
    # last event 02:10 -> watermark 01:55: only hour 0 is closed; bad rows counted nowhere
    assert rows == [(0, 1, 10.0)]


def _one_station(spark, n=4000):
    """One station and one hour: null, NaN, repeated and close depths, in all layers, tied times and missing values."""
    i = F.col("id")
    depth = F.when(i % 50 == 0, F.lit(None)).when(i % 51 == 0, F.lit(float("nan"))).when(i % 3 == 0, F.lit(5.0)).otherwise((i * 7919 % 12000) / 8.0)
    return spark.range(n).select(
        F.timestamp_seconds(1704067200 + (i * 31) % 3600).alias("timestamp"),
        F.lit("hot").alias("location"),
        depth.cast("double").alias("depth"),
        F.when(i % 17 != 0, 10.0 + F.sin(i.cast("double")) * 3).alias("temperature"),
        *[(8.0 + (i % k) / 10.0).alias(c) for c, k in (("salinity", 400), ("dissolved_oxygen", 7), ("ph", 11))],
        *[F.when(i % 5 != 0, (i % k) / 10.0).alias(c) for c, k in (("turbidity", 13), ("chlorophyll", 9), ("current_speed", 8))],
        (i % 360).cast("double").alias("current_direction"),
        i.alias("event_id"),
    )


@pytest.mark.parametrize("scope", ["profile", "layer"])
def test_summaries_equal_the_batch_plan_on_one_station(spark, scope):
    from thermocline.streaming.metrics_stream import ocean_metrics_from_readings

    readings = _one_station(spark)
    batch = ocean_metrics_batch(readings, gradient_scope=scope)
    summed = ocean_metrics_from_readings(readings, gradient_scope=scope)
    assert sum(r["gradient_qc_failures"] for r in batch.collect()) > 100
    assert _rows(summed.select(*batch.columns)) == _rows(batch)


def test_state_of_a_hot_depth_does_not_grow_with_its_rows(spark):
    """Rows that share a depth are one summary; a profile holds a summary a bucket."""
    from thermocline.operators.derive import add_derived
    from thermocline.operators.profile_summary import by_bucket, by_depth
    from thermocline.operators.qc import add_bound_flags

    readings = _one_station(spark)
    flagged = add_bound_flags(add_derived(readings.withColumn("depth", F.floor("depth") % 30 + F.lit(0.5))))
    depths = by_depth(flagged, "1 hour")
    assert depths.count() == flagged.select("depth").distinct().count() <= 32
    assert by_bucket(depths, "1 hour").count() <= 32
    assert "collect_list" not in depths._jdf.queryExecution().optimizedPlan().toString()


def test_staged_stream_keeps_rejects_apart_and_replays(spark, tmp_path):
    from thermocline.operators.derive import parse_messages
    from thermocline.streaming.staged_stream import NO_JSON, NO_TIME, process_batch, read_progress, read_rejects

    good = json.dumps({"timestamp": "2024-01-01T00:10:00", "location": "a", "depth": 5.0, "temperature": 10.0})
    bad = ["", None, "{broken", "[1]", json.dumps({"location": "a"}), json.dumps({"timestamp": "soon"})]
    batch = parse_messages(spark.createDataFrame([(x,) for x in [good, good, *bad]], "value string"), keep_raw="_raw")
    for _ in range(2):  # the second time is a replay
        process_batch(batch, 3, str(tmp_path / "stage"), str(tmp_path / "out"))
    rejects = sorted((r["value"] or "", r["reason"]) for r in read_rejects(spark, str(tmp_path / "stage")).collect())
    assert rejects == sorted([("", NO_JSON), ("", NO_JSON), ("{broken", NO_JSON), ("[1]", NO_JSON), (bad[4], NO_TIME), (bad[5], NO_TIME)])
    assert [tuple(r)[2:] for r in read_progress(spark, str(tmp_path / "stage")).collect()] == [(8, 0, 6)]
