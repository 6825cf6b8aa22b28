"""Projections over the aggregated metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermocline import thresholds as TH
from thermocline.functions.ocean import circular_mean_degrees, classify, compass_degrees


def enrich_metrics(df: DataFrame) -> DataFrame:
    """Add whichever of E1-E5 the available columns allow:

    E1 current_direction_avg = degrees(atan2(sin_avg, cos_avg)), in (-180, 180], and
       current_direction_compass, the same bearing in [0, 360)
    E2 temp_gradient = (temp_max - temp_min) / (max_depth - min_depth), NULL on zero span
    E3 data_quality from measurement_count
    E4 qc_score = 100 - 5 * (sum of the five failure counts), may be negative
    E5 quality_category from qc_score
    """
    have = set(df.columns)
    cols = {}
    if {"current_direction_sin_avg", "current_direction_cos_avg"} <= have:
        mean = circular_mean_degrees("current_direction_sin_avg", "current_direction_cos_avg")
        cols["current_direction_avg"] = mean
        cols["current_direction_compass"] = compass_degrees(mean)
    if {"temp_max", "temp_min", "max_depth", "min_depth"} <= have:
        cols["temp_gradient"] = F.try_divide(
            F.col("temp_max") - F.col("temp_min"), F.col("max_depth") - F.col("min_depth")
        )
    if "measurement_count" in have:
        cols["data_quality"] = classify(F.col("measurement_count"), TH.DATA_QUALITY_CLASSES, TH.DATA_QUALITY_DEFAULT)
    if set(TH.QC_SCORE_FAILURES) <= have:
        total = sum((F.col(c) for c in TH.QC_SCORE_FAILURES[1:]), F.col(TH.QC_SCORE_FAILURES[0]))
        score = (F.lit(TH.QC_SCORE_START) - total * F.lit(TH.QC_SCORE_PENALTY)).cast("bigint")
        cols["qc_score"] = score
        cols["quality_category"] = classify(score, TH.QUALITY_CATEGORIES, TH.QUALITY_CATEGORY_DEFAULT)
    return df.withColumns(cols)
