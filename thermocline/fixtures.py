"""Test inputs derived by Spark from the given ``events`` table (FIXTURES.md §2-3).

The shared test data has no ocean tables; every fixture here is a fixed,
row-by-row projection of ``events``, so its size grows with the table and the
same formula can be written in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline.session import ensure_utc


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given ``events`` table of a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _d(c: Column) -> Column:
    return c.cast("double")


def reading_columns(ev: DataFrame) -> list[Column]:
    """The ``readings`` projection of an events frame (event_id kept for ties)."""
    k, eid, value = _k(), F.col("event_id"), F.col("value")
    kd = _d(k)
    return [
        eid.alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("station_"), (F.col("user_id") % 5).cast("string")).alias("location"),
        (_d(k * k) / F.lit(5.0)).alias("depth"),
        (F.lit(24.0) - kd * F.lit(0.22) + _d(eid % 41 - 20) * F.lit(0.5)).alias("temperature"),
        (F.lit(34.5) + _d(eid % 23 - 11) * F.lit(0.7)).alias("salinity"),
        (F.lit(7.0) - kd * F.lit(0.05) + _d(eid % 29 - 14) * F.lit(0.4)).alias("dissolved_oxygen"),
        (F.lit(7.75) + _d(eid % 19 - 9) * F.lit(0.1)).alias("ph"),
        value.alias("turbidity"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
        .otherwise((value % F.lit(40.0)) / (F.lit(1.0) + kd / F.lit(10.0)))
        .alias("chlorophyll"),
        F.when(eid % 11 == 0, F.lit(None).cast("double")).otherwise(_d(eid % 37) * F.lit(0.1)).alias("current_speed"),
        F.when(eid % 11 == 0, F.lit(None).cast("double")).otherwise(_d((eid * 53) % 360)).alias("current_direction"),
    ]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ocean readings: event_id + the 11 common columns (timestamp as TIMESTAMP, UTC)."""
    ensure_utc(spark)
    ev = events(spark, sf_dir)
    return ev.select(*reading_columns(ev))


def scaled_readings(spark: SparkSession, sf_dir: str, copies: int = 10) -> DataFrame:
    """``readings`` x ``copies`` with location suffixed _0.._{copies-1}; a generator
    (explode), not a join. event_id stays unique: event_id * copies + copy."""
    base = readings(spark, sf_dir)
    rep = base.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return rep.withColumns(
        {
            "event_id": F.col("event_id") * F.lit(copies) + F.col("_copy"),
            "location": F.concat(F.col("location"), F.lit("_"), F.col("_copy").cast("string")),
        }
    ).drop("_copy")


def air_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality messages (six fields) plus event_id."""
    ensure_utc(spark)
    ev = events(spark, sf_dir)
    k, eid = _k(), F.col("event_id")
    return ev.select(
        eid.alias("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("sensor_"), (F.col("user_id") % 5 + 1).cast("string")).alias("location"),
        (F.lit(350.0) + _d(eid % 151)).alias("co2_level"),
        (F.lit(15.0) + _d(k % 16)).alias("temperature"),
        (F.lit(30.0) + _d(eid % 41)).alias("humidity"),
        (F.col("value") % F.lit(50.0)).alias("particulate_matter"),
    )


def impact_score(avg_co2: Column, avg_temp: Column, avg_humidity: Column, max_pm25: Column) -> Column:
    """ML label for the air-quality model (ours; the original defines none)."""
    return F.lit(0.01) * avg_co2 + F.lit(0.5) * avg_temp + F.lit(0.1) * avg_humidity + F.lit(0.2) * max_pm25
