"""Queries over the landed-feed readers and message parsers (registered on import)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline import feed_fixtures as FF
from thermocline import fixtures as FX
from thermocline.operators.derive import parse_messages
from thermocline.operators.timerange import last_hours
from thermocline.plans.catalog import query, rounded
from thermocline.schemas import READING_COLUMNS
from thermocline.session import checkpoint_root
from thermocline.sources.combine import source_validity, union_sources
from thermocline.sources.feeds import observatory_feed_from, station_feed
from thermocline.sources.float_profiles import conform_float, float_list, profiles_of_listed_floats
from thermocline.sources.landing import file_stem
from thermocline.sources.messages import message_schema, readings_from_json_map
from thermocline.sources.observatory_json import (
    conform_observatory,
    observatory_feed,
    parse_inventory,
    parse_observatory_docs,
)
from thermocline.sources.product_tables import catalogue_datasets, conform_product, products_of_catalogue
from thermocline.sources.station_text import conform_station, parse_station_lines, station_list

AS_OF = "2024-01-15 12:00:00"


def _out(df):
    """Common-schema output in comparison form: wall-clock timestamp, rounded doubles."""
    return rounded(df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))


def _station(spark, sf_dir):
    readings, _ = parse_station_lines(FF.station_lines(spark, sf_dir))
    return readings


def _observatory(spark, sf_dir):
    points, _ = parse_observatory_docs(FF.observatory_docs(spark, sf_dir))
    return observatory_feed(points, parse_inventory(FF.inventory_docs(spark, sf_dir)))


def _floats(spark, sf_dir):
    return profiles_of_listed_floats(FF.float_profile_rows(spark, sf_dir), float_list(FF.float_list_lines(spark, sf_dir)))


def _products(spark, sf_dir):
    return products_of_catalogue(FF.product_rows(spark, sf_dir), catalogue_datasets(FF.catalogue_docs(spark, sf_dir)))


@query("parse_json_readings")
def parse_json_readings(spark, sf_dir):
    """Messages as binary payloads -> typed readings."""
    raw = FF.reading_messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    schema = message_schema(T.StructType([T.StructField("event_id", T.LongType())]))
    return _out(parse_messages(raw, schema).select("event_id", *READING_COLUMNS))


@query("json_reading_defaults")
def json_reading_defaults(spark, sf_dir):
    """Required fields, 0.0 defaults for depth and salinity, rejects dropped."""
    readings, _ = readings_from_json_map(FF.reading_messages(spark, sf_dir, drop_fields=True), keep=["event_id"])
    return _out(readings.withColumn("event_id", F.col("event_id").cast("long")))


@query("json_reading_rejects")
def json_reading_rejects(spark, sf_dir):
    """S14 rejects: messages lacking a required field, counted per reason."""
    _, rejects = readings_from_json_map(FF.reading_messages(spark, sf_dir, drop_fields=True), keep=["event_id"])
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


@query("last_24_hours")
def last_24_hours(spark, sf_dir):
    return _out(last_hours(FX.readings(spark, sf_dir), AS_OF, 24))


@query("ndbc_station_feed")
def ndbc_station_feed(spark, sf_dir):
    """Station files -> common schema (bad files dropped)."""
    return _out(conform_station(_station(spark, sf_dir)))


@query("station_rejects")
def station_rejects(spark, sf_dir):
    """Rejected station lines per file and reason (short rows, and the other
    rows of files that contain one)."""
    _, rejects = parse_station_lines(FF.station_lines(spark, sf_dir))
    return rejects.groupBy(file_stem("file").alias("location"), "reason").agg(
        F.count(F.lit(1)).alias("n_lines")
    )


def _land(df, name: str, *folders: str) -> str:
    """Write the ``value`` column of ``df`` as text files, in folders by the other columns; the landing path."""
    path = f"{checkpoint_root(df.sparkSession)}/thermocline/landing-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).text(path)
    return path


def _land_stations(spark, sf_dir):
    lines = FF.station_lines(spark, sf_dir).withColumn("station", file_stem("file"))
    in_files = lines.repartition("station").sortWithinPartitions("station", "line_no")
    return _land(in_files.select("station", F.col("line").alias("value")), "stations", "station")


STATION_FOLDER = r"station=([^/]+)/"


@query("landed_station_feed")
def landed_station_feed(spark, sf_dir):
    """S4, F1, F2, S16, C1 over station files on disk, read by byte range (one folder a station)."""
    readings, _ = station_feed(spark, _land_stations(spark, sf_dir), location=F.regexp_extract("file", STATION_FOLDER, 1))
    return _out(readings)


@query("landed_station_rejects")
def landed_station_rejects(spark, sf_dir):
    """S16 over the same files: rejected lines per station and reason, with the first one's number."""
    _, rejects = station_feed(spark, _land_stations(spark, sf_dir), location=F.regexp_extract("file", STATION_FOLDER, 1))
    return rejects.groupBy(F.regexp_extract("file", STATION_FOLDER, 1).alias("location"), "reason").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("line_no").alias("first_line")
    )


@query("landed_observatory_feed")
def landed_observatory_feed(spark, sf_dir):
    """S6, S7, S8, C2 over document files on disk, a document a line, and inventory files."""
    docs = FF.observatory_docs(spark, sf_dir).select(F.regexp_extract("file", "observatory/(.*)/part", 1).alias("at"), "value")
    parts = F.split("at", "/")
    landed = _land(docs.select(parts[0].alias("node"), parts[1].alias("instrument"), "value"), "documents", "node", "instrument")
    inventory = FF.inventory_docs(spark, sf_dir).select(file_stem("file").alias("of"), "value")
    feed, _ = observatory_feed_from(spark, landed, _land(inventory, "inventory", "of"), per_line=True)
    return _out(feed)


@query("ndbc_station_list")
def ndbc_station_list(spark, sf_dir):
    return station_list(FF.station_table_lines(spark, sf_dir))


@query("ooi_feed")
def ooi_feed(spark, sf_dir):
    """Documents of inventoried instruments -> common schema."""
    return _out(conform_observatory(_observatory(spark, sf_dir)))


@query("ooi_inventory")
def ooi_inventory(spark, sf_dir):
    return parse_inventory(FF.inventory_docs(spark, sf_dir))


@query("argo_profiles")
def argo_profiles(spark, sf_dir):
    return _out(conform_float(_floats(spark, sf_dir)))


@query("argo_float_list")
def argo_float_list(spark, sf_dir):
    return float_list(FF.float_list_lines(spark, sf_dir))


@query("cmems_catalogue")
def cmems_catalogue(spark, sf_dir):
    return catalogue_datasets(FF.catalogue_docs(spark, sf_dir))


@query("cmems_products")
def cmems_products(spark, sf_dir):
    return _out(conform_product(_products(spark, sf_dir)))


@query("source_validity")
def source_validity_q(spark, sf_dir):
    """V1-V4, F3 on each source's native frame."""
    points, _ = parse_observatory_docs(FF.observatory_docs(spark, sf_dir))
    return source_validity(
        {
            "station": _station(spark, sf_dir),
            "observatory": points,
            "product": FF.product_rows(spark, sf_dir),
            "float": FF.float_profile_rows(spark, sf_dir),
        }
    )


@query("all_sources_union")
def all_sources_union(spark, sf_dir):
    """Every source conformed and merged."""
    merged = union_sources(
        {
            "station": conform_station(_station(spark, sf_dir)),
            "observatory": conform_observatory(_observatory(spark, sf_dir)),
            "float": conform_float(_floats(spark, sf_dir)),
            "product": conform_product(_products(spark, sf_dir)),
        }
    )
    return _out(merged)
