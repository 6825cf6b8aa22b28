"""The metrics stream without per-group state: stage rows, close windows in batch.

The stateful form in ``metrics_stream`` keeps its summaries in the state store until a window
closes. Here nothing is kept in executor memory between batches, and messages that cannot be
used are kept apart. Each micro-batch (``foreachBatch``):

1. lands its readings as Parquet under ``stage_path/rows``, partitioned by
   (window date, batch id); rows of windows already closed by earlier batches
   are late, as in the stateful form: they go to ``stage_path/late`` instead;
2. writes messages that give no reading to ``stage_path/rejects``, partitioned by batch id,
   with the raw text and a reason (error isolation: the stream goes on);
3. records, in ``stage_path/progress``, one row per batch: the largest event time and the numbers
   of messages, of late rows and of rejects, observed while the batch is written;
4. computes the windows that the new watermark (largest event time - delay)
   has closed, reading only their dates from the landed rows, with the batch
   plan (``ocean_metrics_batch``: skew-safe profile ordering, one shuffle when
   groups are small) and writes them to the sink partitioned by (window date,
   batch id).

Every write replaces exactly the partitions of its own batch id
(``partitionOverwriteMode=dynamic``), and everything a batch computes depends
only on its own rows and on earlier batches, so a replayed batch rewrites the
same files: all outputs stay exactly-once across restarts. State is the landed rows
on shared storage, not executor memory.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from thermocline import thresholds as TH
from thermocline.operators.derive import parse_messages
from thermocline.plans.ocean_metrics import ocean_metrics_batch
from thermocline.schemas import READING_MESSAGE_SCHEMA, READING_SCHEMA

_WDATE, _BATCH, _RAW = "_wdate", "_batch", "_raw"
PROGRESS_SCHEMA = "_batch long, max_event_time timestamp, n_messages long, n_late long, n_rejected long"
NO_JSON, NO_TIME = "not a JSON object", "missing or bad timestamp"


def _interval(text: str):
    return F.expr(f"INTERVAL {text}")


def _watermark_micros(progress: DataFrame, delay: str):
    """Largest event time in ``progress`` minus the delay, as epoch microseconds
    (an integer, so no time zone is involved on the way through the driver)."""
    row = progress.agg(F.unix_micros(F.max("max_event_time") - _interval(delay)).alias("wm")).first()
    return row["wm"] if row else None


def _at(micros: int):
    return F.timestamp_micros(F.lit(micros))


def _previous_watermark(spark, progress_path: str, batch_id: int, delay: str):
    """Watermark in force before ``batch_id``: largest event time of earlier
    batches minus the delay (None before any data)."""
    try:
        progress = spark.read.schema(PROGRESS_SCHEMA).parquet(progress_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing landed yet; any other failure fails the batch
    return _watermark_micros(progress.filter(F.col(_BATCH) < batch_id), delay)


def _overwrite_own_partitions(df: DataFrame, path: str, *partition_cols: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def _is_object() -> Column:
    """Whether the raw message is a JSON object, whatever its fields."""
    return F.coalesce(F.json_object_keys(_RAW).isNotNull(), F.lit(False))


def process_batch(
    batch: DataFrame,
    batch_id: int,
    stage_path: str,
    sink_path: str,
    duration: str = TH.WINDOW_DURATION,
    delay: str = TH.WATERMARK_DELAY,
    gradient_scope: str = "profile",
) -> None:
    """One micro-batch of the staged metrics stream (see module docstring)."""
    spark = batch.sparkSession
    rows_path, progress_path = f"{stage_path}/rows", f"{stage_path}/progress"
    prev = _previous_watermark(spark, progress_path, batch_id, delay)
    if _RAW not in batch.columns:
        batch = batch.withColumn(_RAW, F.to_json(F.struct(*batch.columns)))

    # window() drops rows without a time, but rejects have none
    w = F.window(F.coalesce("timestamp", F.timestamp_seconds(F.lit(0))), duration)
    late = (F.col("_wend") <= _at(prev)) if prev is not None else F.lit(False)  # an earlier batch has emitted the window
    kind = F.when(F.col("timestamp").isNull(), F.lit("rejects")).when(late, F.lit("late")).otherwise(F.lit("rows"))
    seen = Observation()
    batch = batch.withColumns({"_wstart": w.start, "_wend": w.end, _BATCH: F.lit(batch_id).cast("long")})
    batch = batch.withColumn("_kind", kind).persist()  # one parse of the messages for the writes below; one micro-batch only
    counted = batch.observe(
        seen,
        F.max("timestamp").alias("max_event_time"),
        F.count(F.lit(1)).alias("n_messages"),
        F.count_if(F.col("_kind") == "late").alias("n_late"),
        F.count_if(F.col("_kind") == "rejects").alias("n_rejected"),
    )
    landed = counted.where("_kind = 'rows'").drop("_kind", _RAW).withColumn(_WDATE, F.to_date("_wstart"))
    _overwrite_own_partitions(landed, rows_path, _WDATE, _BATCH)
    got = seen.get
    if got["n_late"]:
        _overwrite_own_partitions(batch.where("_kind = 'late'").drop("_kind", "_wstart", "_wend", _RAW), f"{stage_path}/late", _BATCH)
    if got["n_rejected"]:
        reason = F.when(_is_object(), F.lit(NO_TIME)).otherwise(F.lit(NO_JSON))
        bad = batch.where("_kind = 'rejects'").select(F.col(_RAW).alias("value"), reason.alias("reason"), _BATCH)
        _overwrite_own_partitions(bad, f"{stage_path}/rejects", _BATCH)
    batch.unpersist()
    progress = spark.createDataFrame([(batch_id, got["max_event_time"], got["n_messages"], got["n_late"], got["n_rejected"])], PROGRESS_SCHEMA)
    _overwrite_own_partitions(progress, progress_path, _BATCH)

    latest = spark.read.schema(PROGRESS_SCHEMA).parquet(progress_path).filter(F.col(_BATCH) <= batch_id)
    now = _watermark_micros(latest, delay)
    if now is None or (prev is not None and now <= prev):
        return
    closing = F.col("_wend") <= _at(now)
    date_hi = F.to_date(_at(now))
    staged = spark.read.parquet(rows_path).filter(F.col(_WDATE) <= date_hi)
    if prev is not None:
        # windows ending after the previous watermark start no earlier than one
        # window length before it
        date_lo = F.to_date(_at(prev) - _interval(duration))
        staged = staged.filter((F.col(_WDATE) >= date_lo) & (F.col("_wend") > _at(prev)))
    staged = staged.filter(closing).drop("_wstart", "_wend", _WDATE, _BATCH)
    metrics = ocean_metrics_batch(staged, duration, gradient_scope=gradient_scope)
    out = metrics.withColumns({"window_date": F.to_date("window_start"), _BATCH: F.lit(batch_id).cast("long")})
    _overwrite_own_partitions(out.repartition("window_date", "location"), sink_path, "window_date", _BATCH)


def start_staged_metrics_stream(
    raw: DataFrame,
    stage_path: str,
    sink_path: str,
    checkpoint_path: str,
    duration: str = TH.WINDOW_DURATION,
    delay: str = TH.WATERMARK_DELAY,
    gradient_scope: str = "profile",
    with_event_id: bool = True,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Raw ``value`` messages -> staged rows -> closed-window metrics in
    ``sink_path`` (columns of ``ocean_metrics_batch`` plus window_date and the
    emitting batch id as partition columns)."""
    extra = [T.StructField("event_id", T.LongType(), True)] if with_event_id else []
    readings = parse_messages(raw, T.StructType(READING_MESSAGE_SCHEMA.fields + extra), keep_raw=_RAW)
    writer = readings.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(
        lambda df, bid: process_batch(df, bid, stage_path, sink_path, duration, delay, gradient_scope)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_staged_metrics(spark, sink_path: str) -> DataFrame:
    """The staged stream's output table without its partition columns."""
    return spark.read.parquet(sink_path).drop("window_date", _BATCH)


def read_progress(spark, stage_path: str) -> DataFrame:
    """One row per batch: batch, max_event_time, n_messages, n_late and n_rejected."""
    progress = spark.read.schema(PROGRESS_SCHEMA).parquet(f"{stage_path}/progress")
    return progress.select(F.col(_BATCH).alias("batch"), "max_event_time", "n_messages", "n_late", "n_rejected")


def _side_output(spark, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(f"{schema}, _batch long").parquet(path).withColumnRenamed(_BATCH, "batch")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch long")  # no batch had any


def read_rejects(spark, stage_path: str) -> DataFrame:
    """Batch, value (the raw message) and reason of messages that gave no reading."""
    return _side_output(spark, f"{stage_path}/rejects", "value string, reason string")


def read_late_rows(spark, stage_path: str) -> DataFrame:
    """T4: batch and reading of rows that arrived after their window was emitted."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in READING_SCHEMA.fields)
    return _side_output(spark, f"{stage_path}/late", f"{fields}, event_id long")
