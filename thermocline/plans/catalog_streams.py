"""Queries over Structured Streaming jobs and Spark ML (registered on import)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from thermocline import feed_fixtures as FF
from thermocline import fixtures as FX
from thermocline.ml.models import (
    AIR_FEATURES,
    AIR_LABEL,
    OCEAN_FEATURES,
    OCEAN_LABEL,
    feature_assembler,
    fit_and_score,
    gbt_pipeline,
    with_checked_predictions,
)
from thermocline.operators.metrics import air_quality_metrics
from thermocline.plans.catalog import query, rounded
from thermocline.plans.ocean_metrics import ocean_metrics_batch
from thermocline.plans.pipeline import (
    changed_dates,
    read_metrics_table,
    refresh_metrics_table,
    run_pipeline,
    write_metrics_table,
)
from thermocline.session import checkpoint_root, materialize
from thermocline.sources.messages import read_message_stream
from thermocline.streaming.metrics_stream import (
    air_metrics_from_messages,
    ocean_metrics_from_messages,
    start_append_stream,
)
from thermocline.streaming.staged_stream import (
    read_late_rows,
    read_progress,
    read_rejects,
    read_staged_metrics,
    start_staged_metrics_stream,
)


def _run_available_now(spark, messages, build):
    """Land ``messages`` as JSON lines in the shared folder, run ``build`` over the
    folder as a stream with trigger(availableNow) and return the sink table."""
    root = f"{checkpoint_root(spark)}/thermocline/stream-{uuid.uuid4().hex}"
    messages.write.text(f"{root}/in")
    metrics = build(read_message_stream(spark, "text", path=f"{root}/in"))
    q = start_append_stream(metrics, f"{root}/out", f"{root}/chk", trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("window_date")


@query("ocean_metrics_stream")
def ocean_metrics_stream(spark, sf_dir):
    """The metrics job as an append stream; emitted = closed windows."""
    out = _run_available_now(
        spark,
        FF.reading_messages(spark, sf_dir),
        lambda raw: ocean_metrics_from_messages(raw, gradient_scope="layer"),
    )
    return rounded(out)


@query("ocean_metrics_stream_profile")
def ocean_metrics_stream_profile(spark, sf_dir):
    """T1-T8 with gradient pairs across layers (chained stateful aggregation)."""
    out = _run_available_now(
        spark,
        FF.reading_messages(spark, sf_dir),
        lambda raw: ocean_metrics_from_messages(raw, gradient_scope="profile"),
    )
    return rounded(out)


@query("ocean_metrics_stream_staged")
def ocean_metrics_stream_staged(spark, sf_dir):
    """T1-T8 without per-group state: micro-batches are landed and closed windows
    are computed with the (skew-safe) batch plan; profile gradient scope."""
    root = f"{checkpoint_root(spark)}/thermocline/staged-{uuid.uuid4().hex}"
    FF.reading_messages(spark, sf_dir).write.text(f"{root}/in")
    q = start_staged_metrics_stream(
        read_message_stream(spark, "text", path=f"{root}/in"),
        f"{root}/stage",
        f"{root}/out",
        f"{root}/chk",
        trigger={"availableNow": True},
    )
    q.awaitTermination()
    return rounded(read_staged_metrics(spark, f"{root}/out"))


def _in_deliveries(spark, messages, start):
    """Land the two deliveries one after the other; after each, and once more with nothing new, ``start`` a stream on
    the same folders and checkpoint, run it to its end and stop it."""
    root = f"{checkpoint_root(spark)}/thermocline/deliveries-{uuid.uuid4().hex}"
    for delivery in (1, 2, None):
        if delivery:
            messages.where(F.col("delivery") == delivery).select("value").write.mode("append").text(f"{root}/in")
        q = start(read_message_stream(spark, "text", path=f"{root}/in"), root)
        q.awaitTermination()
        q.stop()
    return root


@query("ocean_metrics_stream_restart")
def ocean_metrics_stream_restart(spark, sf_dir):
    """The stateful stream stopped and started anew on one checkpoint between two deliveries, of which the
    second holds rows of closed windows: those are dropped, and no window is emitted twice or lost."""

    def start(raw, root):
        metrics = ocean_metrics_from_messages(raw, gradient_scope="profile")
        return start_append_stream(metrics, f"{root}/out", f"{root}/chk", trigger={"availableNow": True})

    root = _in_deliveries(spark, FF.delivered_messages(spark, sf_dir), start)
    return rounded(spark.read.parquet(f"{root}/out").drop("window_date"))


def _staged_in_deliveries(spark, sf_dir, broken):
    def start(raw, root):
        return start_staged_metrics_stream(raw, f"{root}/stage", f"{root}/out", f"{root}/chk", trigger={"availableNow": True})

    return _in_deliveries(spark, FF.delivered_messages(spark, sf_dir, broken), start)


@query("stream_late_counts")
def stream_late_counts(spark, sf_dir):
    """T4: messages, late rows and rejects of each batch, observed as the batches are written, and the late rows kept."""
    stage = f"{_staged_in_deliveries(spark, sf_dir, broken=False)}/stage"
    kept = read_late_rows(spark, stage).groupBy("batch").agg(F.count(F.lit(1)).alias("late_rows"), F.sum("event_id").alias("late_id_sum"))
    out = read_progress(spark, stage).join(kept, "batch", "left").withColumn("max_event_time", F.col("max_event_time").cast("timestamp_ntz"))
    return out.fillna(0, ["late_rows", "late_id_sum"])


@query("stream_rejects")
def stream_rejects(spark, sf_dir):
    """S16 on a stream: broken messages in a second sink, per batch and reason, with the metrics still emitted."""
    root = _staged_in_deliveries(spark, sf_dir, broken=True)
    rejects = read_rejects(spark, f"{root}/stage")
    id_of = F.regexp_extract("value", r'"event_id":(\d+)', 1).try_cast("long")
    out = rejects.groupBy("batch", "reason").agg(F.count(F.lit(1)).alias("n_messages"), F.sum(id_of).alias("id_sum"))
    emitted = read_staged_metrics(spark, f"{root}/out").agg(F.sum("measurement_count")).scalar()
    return out.withColumn("emitted_rows", emitted)


@query("air_quality_stream")
def air_quality_stream(spark, sf_dir):
    """S17, A31-A34 on the air-quality message stream (closed windows)."""
    air = FX.air_readings(spark, sf_dir)
    msgs = air.select(
        F.to_json(
            F.struct(
                F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                *[c for c in air.columns if c not in ("timestamp", "event_id")],
            )
        ).alias("value")
    )
    return rounded(_run_available_now(spark, msgs, air_metrics_from_messages))


def _air_table(spark, sf_dir):
    m = air_quality_metrics(FX.air_readings(spark, sf_dir))
    return m.withColumn(
        AIR_LABEL,
        FX.impact_score(F.col("avg_co2"), F.col("avg_temp"), F.col("avg_humidity"), F.col("max_pm25")),
    )


@query("air_features")
def air_features(spark, sf_dir):
    """M1: the assembled feature vector, unpacked to columns for comparison."""
    v = feature_assembler(AIR_FEATURES).transform(_air_table(spark, sf_dir))
    arr = vector_to_array("features")
    return rounded(
        v.select(
            "window_start",
            "location",
            *[arr[i].alias(f"feature_{i}") for i in range(len(AIR_FEATURES))],
            AIR_LABEL,
        )
    )


def _checked(model, predictions, evaluation, features, label, keys):
    """Per row: label, split, and whether there is a prediction that the exported trees give as well; the model explains
    most of the variance of the rows held out (R2 over one half)."""
    out = with_checked_predictions(model, predictions, features)
    return rounded(
        out.select(
            *keys, label, "is_test", F.col("prediction").isNotNull().alias("has_prediction"), "same_prediction",
            F.lit(evaluation["r2"] > 0.5).alias("explains_held_out"),
        )
    )


@query("impact_model")
def impact_model(spark, sf_dir):
    """M2-M4: GBT on hourly air-quality metrics; each row's prediction checked against the exported trees."""
    keys = ["window_start", "location"]
    model, preds, evaluation = fit_and_score(gbt_pipeline(AIR_FEATURES, AIR_LABEL), _air_table(spark, sf_dir), AIR_LABEL, keys=keys)
    return _checked(model, preds, evaluation, AIR_FEATURES, AIR_LABEL, keys)


@query("metrics_table")
def metrics_table(spark, sf_dir):
    """S3: the hourly metrics written as a table, one folder per date, and read back."""
    path = f"{checkpoint_root(spark)}/thermocline/metrics-{uuid.uuid4().hex}"
    write_metrics_table(ocean_metrics_batch(FX.readings(spark, sf_dir)), path)
    return rounded(read_metrics_table(spark, path))


@query("metrics_table_refresh")
def metrics_table_refresh(spark, sf_dir):
    """S3, M6: a table of metrics of the readings without held-back ones; these arrive late, and the dates they belong to
    are worked out again and replaced alone. ``rewritten``: the row's folder holds other files than before."""
    path = f"{checkpoint_root(spark)}/thermocline/metrics-{uuid.uuid4().hex}"
    readings = FX.readings(spark, sf_dir)
    held = FF.held_back(readings)
    write_metrics_table(ocean_metrics_batch(readings.where(~held)), path)
    files = lambda: spark.read.parquet(path).select("window_date", F.col("_metadata.file_name").alias("file")).distinct()
    before = materialize(files(), "metrics-files")
    refresh_metrics_table(readings, path, changed_dates(readings.where(held)))
    new = files().join(before, ["window_date", "file"], "left_anti").select("window_date").distinct().withColumn("new", F.lit(True))
    out = spark.read.parquet(path).join(new, "window_date", "left").withColumn("rewritten", F.coalesce("new", F.lit(False)))
    return rounded(out.drop("new", "window_date"))


@query("ocean_model")
def ocean_model(spark, sf_dir):
    """M5, M6: readings -> ocean metrics -> GBT (oxygen saturation from
    temperature, salinity, oxygen and pH means), checked as ``impact_model``."""
    _, model, preds, evaluation = run_pipeline(FX.readings(spark, sf_dir))
    return _checked(model, preds, evaluation, OCEAN_FEATURES, OCEAN_LABEL, ["window_start", "location", "depth_layer"])
