"""One call per feed: landing folder -> common-schema readings.

Each function reads a landing folder with Spark, parses it (no driver-side
parsing), raises when nothing usable arrived, and returns the conformed
11-column frame plus the rejects. ``all_feeds`` merges whichever feeds are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline.sources.combine import union_sources
from thermocline.sources.float_profiles import (
    conform_float,
    float_list,
    profiles_of_listed_floats,
    read_float_profiles,
)
from thermocline.sources.landing import read_landed_lines, read_landed_text, require_rows
from thermocline.sources.observatory_json import (
    conform_observatory,
    observatory_feed,
    parse_inventory,
    parse_observatory_docs,
)
from thermocline.sources.product_tables import (
    catalogue_datasets,
    conform_product,
    products_of_catalogue,
    read_products,
)
from thermocline.sources.station_text import conform_station, parse_station_lines, station_list


def station_feed(
    spark: SparkSession, stations_path: str, station_table_path: str | None = None, **parse_options
) -> tuple[DataFrame, DataFrame]:
    """Station text files (one per station, of any size: they are read by byte range) -> (readings, rejects).
    With a station table, only listed stations are kept. Raises when no station gave data."""
    readings, rejects = parse_station_lines(read_landed_lines(spark, stations_path), **parse_options)
    if station_table_path:
        listed = station_list(read_landed_lines(spark, station_table_path)).withColumnRenamed("station_id", "location")
        readings = readings.join(listed.distinct(), "location", "left_semi")
    return require_rows(conform_station(readings), "No data could be retrieved from any station"), rejects


def observatory_feed_from(
    spark: SparkSession, docs_path: str, inventory_path: str, missing: str = "zero", per_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Observatory JSON documents under <node>/<instrument>/ -> (readings, rejects). With ``per_line`` each line of
    a file is a document: such files may be of any size, as they are read by byte range."""
    if per_line:
        docs = read_landed_lines(spark, docs_path, numbered=False).where(F.trim("line") != "").select("file", F.col("line").alias("value"))
    else:
        docs = read_landed_text(spark, docs_path)
    points, rejects = parse_observatory_docs(docs, missing)
    inventory = parse_inventory(read_landed_text(spark, inventory_path))
    feed = conform_observatory(observatory_feed(points, inventory))
    return require_rows(feed, "No data could be retrieved from any instrument"), rejects


def float_feed(spark: SparkSession, float_list_path: str, profiles_path: str, fmt: str = "parquet") -> DataFrame:
    """Float list + landed profiles -> readings of listed floats."""
    floats = float_list(read_landed_lines(spark, float_list_path))
    profiles = profiles_of_listed_floats(read_float_profiles(spark, profiles_path, fmt), floats)
    return require_rows(conform_float(profiles), "No data could be retrieved from any float")


def product_feed(spark: SparkSession, catalogue_path: str, products_path: str, fmt: str = "parquet") -> DataFrame:
    """XML catalogue + landed product rows -> readings of catalogued datasets."""
    datasets = catalogue_datasets(read_landed_text(spark, catalogue_path))
    products = products_of_catalogue(read_products(spark, products_path, fmt), datasets)
    return require_rows(conform_product(products), "No data could be retrieved from any dataset")


def all_feeds(frames: dict[str, DataFrame]) -> DataFrame:
    """Merge conformed feeds into one readings table with a ``source`` column."""
    return union_sources(frames)
