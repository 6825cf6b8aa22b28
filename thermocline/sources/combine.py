"""U1 (merge of all sources) and V1-V4 (per-source validity)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline.schemas import READING_COLUMNS

# Columns each source's native frame must have (V1-V4), and whether at least one
# non-NULL temperature is also required. (The original tests the opposite, that
# some temperature IS NULL, which rejects clean data.)
VALIDITY_RULES = {
    "station": (["temperature", "salinity"], True),
    "observatory": (["temperature", "depth"], True),
    "product": (["temperature", "depth"], True),
    "float": (["pressure", "temperature", "salinity"], False),
}


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Conformed frames -> one readings table with a ``source`` column.
    A plain union: no shuffle, each input keeps its partitions."""
    tagged = [df.select(*READING_COLUMNS).withColumn("source", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def validity(name: str, native: DataFrame) -> DataFrame:
    """V1-V4 as one aggregate row: source, has_columns, has_temperature, n_rows,
    valid. Column presence is schema metadata; the NULL test is a single
    distributed ``count`` (no driver-side scan)."""
    cols, needs_temperature = VALIDITY_RULES[name]
    has_cols = all(c in native.columns for c in cols)
    temp = F.count("temperature") > 0 if "temperature" in native.columns else F.lit(False)
    row = native.agg(temp.alias("has_temperature"), F.count(F.lit(1)).alias("n_rows"))
    valid = F.lit(has_cols) & (F.col("has_temperature") if needs_temperature else F.lit(True))
    return row.select(
        F.lit(name).alias("source"), F.lit(has_cols).alias("has_columns"), "has_temperature", "n_rows",
        valid.alias("valid"),
    )


def source_validity(natives: dict[str, DataFrame]) -> DataFrame:
    """One ``validity`` row per named native frame."""
    return reduce(lambda a, b: a.unionByName(b), [validity(n, df) for n, df in natives.items()])
