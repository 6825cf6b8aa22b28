"""Readings of the last N hours before an as-of time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_hours(df: DataFrame, as_of: str | dt.datetime, hours: int = 24, time_col: str = "timestamp") -> DataFrame:
    """Rows with as_of - hours <= time <= as_of (both ends inclusive).

    ``as_of`` is a literal, so the range is constant-folded and can be pushed to
    the scan; the original used "now", which is untestable.
    """
    end = F.lit(as_of).cast("timestamp")
    start = end - F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.filter((F.col(time_col) >= start) & (F.col(time_col) <= end))
