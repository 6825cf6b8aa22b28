"""Observatory JSON documents and the instrument inventory.

A document is ``{"data": [{time, platform_code, depth, ...}, ...]}``; the
inventory is a JSON array of ``{node, instrument}``. Documents are landed as
``<node>/<instrument>/<name>.json``; only inventoried pairs are read (left-semi
join on the pair taken from the path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline.schemas import INVENTORY_SCHEMA, READING_COLUMNS

# Numbers are read as text and cast, so 12.5 and "12.5" both parse (the original
# turns any value into text and then into a double).
NUMERIC_FIELDS = [
    "depth",
    "temperature",
    "salinity",
    "dissolved_oxygen",
    "ph",
    "turbidity",
    "fluorescence",
    "current_speed",
    "current_direction",
]
POINT_TEXT_SCHEMA = T.StructType(
    [T.StructField("time", T.StringType()), T.StructField("platform_code", T.StringType())]
    + [T.StructField(f, T.StringType()) for f in NUMERIC_FIELDS]
)
DOC_TEXT_SCHEMA = T.StructType([T.StructField("data", T.ArrayType(POINT_TEXT_SCHEMA))])

RENAMES = {"time": "timestamp", "platform_code": "location", "fluorescence": "chlorophyll"}


def parse_observatory_docs(docs: DataFrame, missing: str = "zero") -> tuple[DataFrame, DataFrame]:
    """(file, value) -> (points, rejects).

    points: one row per data point with the common names (time -> timestamp,
    platform_code -> location, fluorescence -> chlorophyll); a missing
    number is 0.0 (missing="zero", the original's default) or NULL.
    rejects: (file, reason) for malformed documents and for points lacking time
    or platform_code; with missing="zero" also for points holding a number that
    does not parse, with missing="null" such a number is NULL.
    """
    parsed = docs.select("file", F.from_json("value", DOC_TEXT_SCHEMA).alias("doc"))
    bad_docs = parsed.filter(F.col("doc.data").isNull()).select(
        "file", F.lit("malformed document or no data array").alias("reason")
    )
    points = parsed.select("file", F.explode("doc.data").alias("p")).select("file", "p.*")
    numbers = {}
    for f in NUMERIC_FIELDS:
        v = F.col(f).try_cast("double")
        numbers[RENAMES.get(f, f)] = F.coalesce(v, F.lit(0.0)) if missing == "zero" else v
    garbage = F.lit(False)
    for f in NUMERIC_FIELDS if missing == "zero" else ():  # else it is a NULL, which no one takes for a reading
        garbage = garbage | (F.col(f).isNotNull() & F.col(f).try_cast("double").isNull())
    typed = points.select(
        "file",
        garbage.alias("garbage"),
        F.try_to_timestamp(F.col("time")).alias("timestamp"),
        F.col("platform_code").alias("location"),
        *[c.alias(n) for n, c in numbers.items()],
    )
    required = F.col("timestamp").isNotNull() & F.col("location").isNotNull()
    rejects = bad_docs.unionByName(
        typed.filter(~required).select("file", F.lit("point lacks time or platform_code").alias("reason"))
    ).unionByName(typed.filter(required & F.col("garbage")).select("file", F.lit("unparsable number").alias("reason")))
    return typed.filter(required & ~F.col("garbage")).drop("garbage"), rejects


def parse_inventory(docs: DataFrame) -> DataFrame:
    """(file, value) holding JSON arrays of {node, instrument} -> pairs."""
    pairs = docs.select(F.explode(F.from_json("value", INVENTORY_SCHEMA)).alias("p"))
    return pairs.select("p.node", "p.instrument").filter(F.col("node").isNotNull() & F.col("instrument").isNotNull())


def node_instrument_from_path(points: DataFrame, file_col: str = "file") -> DataFrame:
    """Attach (node, instrument) from a ``.../<node>/<instrument>/<doc>`` path, whose folders may also be
    named ``key=value`` as table writers do."""
    # the last three parts of the path first, so that the pattern is tried at one place only
    tail, pattern = F.substring_index(file_col, "/", -3), r"^(?:\w+=)?([^/]+)/(?:\w+=)?([^/]+)/[^/]+$"
    return points.withColumns(
        {"node": F.regexp_extract(tail, pattern, 1), "instrument": F.regexp_extract(tail, pattern, 2)}
    )


def observatory_feed(points: DataFrame, inventory: DataFrame) -> DataFrame:
    """Keep points of inventoried (node, instrument) pairs only. The inventory
    is small; the semi join lets AQE broadcast it at run time."""
    tagged = node_instrument_from_path(points)
    return tagged.join(inventory.distinct(), ["node", "instrument"], "left_semi")


def conform_observatory(df: DataFrame) -> DataFrame:
    """The common columns in order (the parser already renamed them)."""
    return df.select(*READING_COLUMNS)
