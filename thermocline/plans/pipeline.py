"""M6: the two-step flow, metrics then model, as one function."""

from __future__ import annotations

import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.ml.models import OCEAN_FEATURES, OCEAN_LABEL, fit_and_score, gbt_pipeline
from thermocline.plans.ocean_metrics import ocean_metrics_batch


def read_metrics_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: a metrics table, as a stream sink or ``run_pipeline`` writes it, without its date folders' column."""
    return spark.read.format(fmt).load(path).drop("window_date")


def write_metrics_table(metrics: DataFrame, path: str) -> None:
    """S3: hourly metrics as a table, one folder per window date (the layout of the stream sink). Only the folders of
    dates that ``metrics`` holds are replaced, each as a whole."""
    dated = metrics.withColumn("window_date", F.to_date("window_start"))
    writer = dated.repartition("window_date", "location").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("window_date").parquet(path)


def changed_dates(readings: DataFrame, duration: str = TH.WINDOW_DURATION) -> list[datetime.date]:
    """Window dates that ``readings`` (rows that came late) belong to; as many as days."""
    start = F.to_date(F.window("timestamp", duration).start.cast("timestamp_ntz"))
    return sorted(r[0] for r in readings.where("timestamp IS NOT NULL").select(start).distinct().collect())


def refresh_metrics_table(readings: DataFrame, path: str, dates: list[datetime.date], duration: str = TH.WINDOW_DURATION) -> DataFrame:
    """Work out the given dates' metrics anew from ``readings`` (all of them, late ones included) and replace these dates
    of the table alone. Windows are profiles of their own, so a date needs no reading of another date's windows;
    the bounds on the event time reach the scan of the readings. Returns the table."""
    if dates:
        start = F.window("timestamp", duration).start
        day = F.to_date(start.cast("timestamp_ntz"))
        # the first date's first window may begin a window before midnight, the last one's end after it
        span = F.expr(f"INTERVAL {duration}")
        low, high = F.lit(dates[0]).cast("timestamp") - span, F.lit(dates[-1] + datetime.timedelta(days=1)).cast("timestamp") + span
        in_span = readings.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        own = in_span.withColumn("_day", day).where(F.col("_day").isin(dates)).drop("_day")
        write_metrics_table(ocean_metrics_batch(own, duration), path)
    return read_metrics_table(readings.sparkSession, path)


def run_pipeline(
    readings: DataFrame,
    features: list[str] = OCEAN_FEATURES,
    label: str = OCEAN_LABEL,
    seed: int = 42,
    metrics_path: str | None = None,
) -> tuple[DataFrame, PipelineModel, DataFrame, dict[str, float]]:
    """readings -> hourly ocean metrics (optionally written to ``metrics_path``
    and read back, as the scheduled job hands the table over) -> fitted GBT.

    Returns (metrics, model, predictions, evaluation)."""
    metrics = ocean_metrics_batch(readings)
    if metrics_path:
        write_metrics_table(metrics, metrics_path)
        metrics = read_metrics_table(readings.sparkSession, metrics_path)
    model, predictions, evaluation = fit_and_score(
        gbt_pipeline(features, label, seed=seed), metrics, label, keys=["window_start", "location", "depth_layer"]
    )
    return metrics, model, predictions, evaluation
