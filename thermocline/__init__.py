"""thermocline: ocean-sensor analytics written as plain PySpark DataFrame plans.

Every public function takes and returns a ``DataFrame`` (or a ``Column``), so the
same code runs on batch tables and on Structured Streaming frames where Spark
allows it. Nothing is parsed, collected or looped over on the driver.

Main entry points:

* ``ocean_metrics_batch(readings)`` — hourly statistics, QC counts and scores;
* ``run_metrics_stream(spark, out, checkpoint, ...)`` — the same as a stream;
* ``station_feed`` / ``observatory_feed_from`` / ``float_feed`` /
  ``product_feed`` / ``all_feeds`` — landed feeds to the common reading schema;
* ``gbt_pipeline`` / ``run_pipeline`` — gradient-boosted-tree models.
"""

from thermocline.ml.models import gbt_pipeline
from thermocline.plans.ocean_metrics import ocean_metrics_batch
from thermocline.plans.pipeline import run_pipeline
from thermocline.schemas import AIR_SCHEMA, READING_COLUMNS, READING_SCHEMA
from thermocline.sources.feeds import all_feeds, float_feed, observatory_feed_from, product_feed, station_feed
from thermocline.streaming.metrics_stream import run_metrics_stream

__all__ = [
    "AIR_SCHEMA",
    "READING_COLUMNS",
    "READING_SCHEMA",
    "all_feeds",
    "float_feed",
    "gbt_pipeline",
    "observatory_feed_from",
    "ocean_metrics_batch",
    "product_feed",
    "run_metrics_stream",
    "run_pipeline",
    "station_feed",
]
