"""JSON reading messages, from a message bus or a folder of JSON
lines, as a stream or a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline.functions.parsing import parse_json_once
from thermocline.schemas import MEASUREMENT_COLUMNS, READING_MESSAGE_SCHEMA

DEFAULT_TOPIC = "environmental-sensors"


def read_message_stream(
    spark: SparkSession,
    fmt: str = "text",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame with a ``value`` column (binary from a bus, text from
    files). ``fmt="kafka"`` needs the Kafka source package on the class path;
    ``fmt="text"`` reads new JSON-lines files dropped into ``path``."""
    if fmt == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select("value")
        )
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def message_schema(extra: T.StructType | None = None, base: T.StructType = READING_MESSAGE_SCHEMA) -> T.StructType:
    """The reading message schema with ``extra`` fields appended."""
    return T.StructType(base.fields + (extra.fields if extra else []))


# S14 field rules: which fields a message must carry, and defaults.
REQUIRED_FIELDS = ["timestamp", "location", "temperature"]
DEFAULTED_FIELDS = {"depth": 0.0, "salinity": 0.0}


def readings_from_json_map(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None):
    """Generic JSON object -> reading, with the original's field rules:
    timestamp, location and temperature required; depth and salinity default to
    0.0; the six others optional. Numbers may be JSON numbers or numeric text.

    Returns (readings, rejects); rejects carry the raw value and a reason.
    Extra fields named in ``keep`` (e.g. an event id) are passed through.
    """
    keep = keep or []
    text_schema = T.StructType(
        [T.StructField(f, T.StringType()) for f in ["timestamp", "location", *MEASUREMENT_COLUMNS, *keep]]
    )
    text_cols = ["timestamp", "location", *MEASUREMENT_COLUMNS, *keep]
    parsed = raw.select(F.col(value_col).cast("string").alias("_raw"))
    parsed = parsed.select("_raw", parse_json_once("_raw", text_schema).alias("_m")).select(
        "_raw", *[F.col(f"_m.{c}").alias(f"_t_{c}") for c in text_cols]
    )
    nums = {c: F.col(f"_t_{c}").try_cast("double") for c in MEASUREMENT_COLUMNS}
    typed = parsed.select(
        "_raw",
        *[F.col(f"_t_{k}").alias(k) for k in keep],
        F.try_to_timestamp(F.col("_t_timestamp")).alias("timestamp"),
        F.col("_t_location").alias("location"),
        *[
            (F.coalesce(v, F.lit(DEFAULTED_FIELDS[c])) if c in DEFAULTED_FIELDS else v).alias(c)
            for c, v in nums.items()
        ],
        # a field that is present but not a number is an error, as in the original
        *[(F.col(f"_t_{c}").isNotNull() & nums[c].isNull()).alias(f"_bad_{c}") for c in MEASUREMENT_COLUMNS],
    )
    reason = F.when(F.col("_raw").isNull() | F.col("timestamp").isNull(), F.lit("missing or bad timestamp"))
    reason = reason.when(F.col("location").isNull(), F.lit("missing location"))
    reason = reason.when(F.col("temperature").isNull(), F.lit("missing temperature"))
    for c in MEASUREMENT_COLUMNS:
        reason = reason.when(F.col(f"_bad_{c}"), F.lit(f"{c} is not a number"))
    flagged = typed.withColumn("_reason", reason)
    out_cols = [*keep, "timestamp", "location", *MEASUREMENT_COLUMNS]
    readings = flagged.filter(F.col("_reason").isNull()).select(*out_cols)
    rejects = flagged.filter(F.col("_reason").isNotNull()).select(
        F.col("_raw").alias("value"), F.col("_reason").alias("reason")
    )
    return readings, rejects
