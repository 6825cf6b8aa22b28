"""Product catalogue (XML) and pre-decoded product tables.

The catalogue is an XML document; every ``dataset`` element, at any depth, names
one dataset. Product rows are landed already decoded (NetCDF decoding is outside
this library) with native names ``time`` and ``station_id`` and a ``dataset``
column; only catalogued datasets are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocline.schemas import PRODUCT_SCHEMA, READING_COLUMNS
from thermocline.sources.landing import read_landed_table


def catalogue_datasets(docs: DataFrame) -> DataFrame:
    """(file, value) XML -> dataset_id for each ``dataset`` descendant."""
    ids = docs.select(F.explode(F.xpath(F.col("value"), F.lit("//dataset/text()"))).alias("dataset_id"))
    return ids.select(F.trim("dataset_id").alias("dataset_id")).filter(F.col("dataset_id") != "")


def read_products(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed product rows (native schema plus the dataset id)."""
    schema = T.StructType(PRODUCT_SCHEMA.fields + [T.StructField("dataset", T.StringType(), True)])
    return read_landed_table(spark, path, schema, fmt)


def products_of_catalogue(products: DataFrame, datasets: DataFrame) -> DataFrame:
    """Product rows of catalogued datasets (left-semi join on the dataset id)."""
    return products.join(
        datasets.select(F.col("dataset_id").alias("dataset")).distinct(), "dataset", "left_semi"
    )


def conform_product(df: DataFrame) -> DataFrame:
    """C4: time -> timestamp, station_id -> location, the rest by name."""
    renames = {"timestamp": "time", "location": "station_id"}
    return df.select(*[F.col(renames.get(c, c)).alias(c) for c in READING_COLUMNS])
