"""Message parsing and derived quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline.functions.ocean import density, depth_layer, oxygen_saturation
from thermocline.functions.parsing import parse_json_once
from thermocline.schemas import READING_MESSAGE_SCHEMA


def parse_messages(
    raw: DataFrame,
    schema: T.StructType = READING_MESSAGE_SCHEMA,
    value_col: str = "value",
    time_col: str = "timestamp",
    keep_raw: str | None = None,
) -> DataFrame:
    """JSON payload (binary or text) -> one typed column per field.

    Malformed JSON gives an all-NULL row (PERMISSIVE); unparsable time text gives
    a NULL timestamp (``try_to_timestamp``; plain ``to_timestamp`` raises under
    ANSI). Such rows carry no event time and fall out at windowing. ``keep_raw`` names a column
    that keeps the payload's text.
    """
    text = raw.select(F.col(value_col).cast("string").alias("_v"))
    raw_text = [F.col("_v").alias(keep_raw)] if keep_raw else []
    parsed = text.select("_v", parse_json_once("_v", schema).alias("data")).select("data.*", *raw_text)
    return parsed.withColumn(time_col, F.try_to_timestamp(F.col(time_col)))


def add_derived(df: DataFrame) -> DataFrame:
    """depth_layer, density, oxygen_saturation (one projection)."""
    return df.withColumns(
        {"depth_layer": depth_layer(), "density": density(), "oxygen_saturation": oxygen_saturation()}
    )
