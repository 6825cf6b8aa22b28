"""Profiling floats.

The float list is a text file with one id per line; profiles are landed tables
of (timestamp, float_id, pressure, temperature, salinity). Only listed floats
are kept (left-semi join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.schemas import FLOAT_PROFILE_SCHEMA, READING_COLUMNS
from thermocline.sources.landing import read_landed_table


def float_list(lines: DataFrame) -> DataFrame:
    """(file, line_no, line) or (value) -> float_id, one per non-blank line."""
    text = F.col("line") if "line" in lines.columns else F.col("value")
    return lines.select(F.trim(text).alias("float_id")).filter(F.col("float_id") != "")


def read_float_profiles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed profile rows with a fixed schema (no inference), by column name."""
    return read_landed_table(spark, path, FLOAT_PROFILE_SCHEMA, fmt)


def profiles_of_listed_floats(profiles: DataFrame, floats: DataFrame) -> DataFrame:
    """Profile rows of floats in the list (left-semi join; the list is small)."""
    return profiles.join(floats.distinct(), "float_id", "left_semi")


def conform_float(df: DataFrame, pressure_to_depth: float = TH.PRESSURE_TO_DEPTH) -> DataFrame:
    """float_id -> location, depth = pressure * factor (10 as in the original,
    right for bar; about 1 for dbar), only temperature and salinity measured."""
    none = F.lit(None).cast("double")
    cols = {
        "timestamp": F.col("timestamp"),
        "location": F.col("float_id"),
        "depth": F.col("pressure") * F.lit(pressure_to_depth),
        "temperature": F.col("temperature"),
        "salinity": F.col("salinity"),
    }
    return df.select(*[cols.get(c, none).alias(c) for c in READING_COLUMNS])
