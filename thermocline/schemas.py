"""Schemas of the common reading table, the air-quality message and the feeds."""

from __future__ import annotations

from pyspark.sql import types as T

# The 11-column common reading. Every column is nullable: ``from_json`` drops
# non-null flags anyway, and downstream code must treat NULLs explicitly.
READING_COLUMNS = [
    "timestamp",
    "location",
    "depth",
    "temperature",
    "salinity",
    "dissolved_oxygen",
    "ph",
    "turbidity",
    "chlorophyll",
    "current_speed",
    "current_direction",
]

MEASUREMENT_COLUMNS = READING_COLUMNS[2:]

READING_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType(), True), T.StructField("location", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASUREMENT_COLUMNS]
)

# Wire form of a reading message: the time arrives as text.
READING_MESSAGE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True), T.StructField("location", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASUREMENT_COLUMNS]
)

# Air-quality message (six fields).
AIR_COLUMNS = ["timestamp", "location", "co2_level", "temperature", "humidity", "particulate_matter"]

AIR_MESSAGE_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True), T.StructField("location", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in AIR_COLUMNS[2:]]
)

AIR_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.TimestampType(), True), T.StructField("location", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in AIR_COLUMNS[2:]]
)

# Landed text: one row per file, as ``spark.read.text(..., wholetext=True)`` yields
# it with the file name attached.
LANDED_TEXT_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType(), True), T.StructField("value", T.StringType(), True)]
)

# Landed text split into lines, with the line position inside its file.
LANDED_LINES_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType(), True),
        T.StructField("line_no", T.LongType(), True),
        T.StructField("line", T.StringType(), True),
    ]
)

# One observatory data point inside a JSON document's ``data`` array. Numbers are
# read as doubles; an absent key becomes NULL and is defaulted afterwards.
OBSERVATORY_POINT_SCHEMA = T.StructType(
    [
        T.StructField("time", T.StringType(), True),
        T.StructField("platform_code", T.StringType(), True),
        T.StructField("depth", T.DoubleType(), True),
        T.StructField("temperature", T.DoubleType(), True),
        T.StructField("salinity", T.DoubleType(), True),
        T.StructField("dissolved_oxygen", T.DoubleType(), True),
        T.StructField("ph", T.DoubleType(), True),
        T.StructField("turbidity", T.DoubleType(), True),
        T.StructField("fluorescence", T.DoubleType(), True),
        T.StructField("current_speed", T.DoubleType(), True),
        T.StructField("current_direction", T.DoubleType(), True),
    ]
)

OBSERVATORY_DOC_SCHEMA = T.StructType(
    [T.StructField("data", T.ArrayType(OBSERVATORY_POINT_SCHEMA), True)]
)

INVENTORY_SCHEMA = T.ArrayType(
    T.StructType([T.StructField("node", T.StringType(), True), T.StructField("instrument", T.StringType(), True)])
)

# Float profile rows as landed (native names).
FLOAT_PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("float_id", T.StringType(), True),
        T.StructField("pressure", T.DoubleType(), True),
        T.StructField("temperature", T.DoubleType(), True),
        T.StructField("salinity", T.DoubleType(), True),
    ]
)

# Product table rows as landed (native names ``time`` and ``station_id``).
PRODUCT_SCHEMA = T.StructType(
    [T.StructField("time", T.TimestampType(), True), T.StructField("station_id", T.StringType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in MEASUREMENT_COLUMNS]
)
