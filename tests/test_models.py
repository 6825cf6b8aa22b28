"""The exported trees against the model, and the metrics table's refresh by date."""

from __future__ import annotations

import datetime as dt

from core_shared import SMALL
from pyspark.sql import functions as F

from thermocline import fixtures as FX
from thermocline.ml.models import AIR_FEATURES, fit_and_score, gbt_pipeline, tree_rows, with_checked_predictions
from thermocline.plans.ocean_metrics import ocean_metrics_batch
from thermocline.plans.pipeline import changed_dates, read_metrics_table, refresh_metrics_table, write_metrics_table


def test_exported_trees_predict_as_the_model(spark):
    i = F.col("id")
    df = spark.range(400).select(
        i.alias("key"), *[((i * k) % 97).cast("double").alias(c) for k, c in zip((3, 5, 7, 11), AIR_FEATURES, strict=True)]
    )
    df = df.withColumn("y", F.col("avg_co2") * 2 - F.col("avg_temp") * F.col("avg_humidity") / 50)
    model, predictions, _ = fit_and_score(gbt_pipeline(AIR_FEATURES, "y", max_iter=4, max_depth=3), df, "y", keys=["key"])
    rows = tree_rows(model).collect()
    assert {r["tree"] for r in rows} == set(range(4)) and all((r["feature"] is None) == (r["left"] is None) for r in rows)
    checked = with_checked_predictions(model, predictions, AIR_FEATURES)
    assert checked.count() == 400 and checked.where("same_prediction").count() == 400
    assert checked.select("tree_prediction").distinct().count() > 10


def test_refresh_rewrites_changed_dates_alone(spark, tmp_path):
    path = str(tmp_path / "metrics")
    readings = FX.readings(spark, SMALL)
    day = F.to_date("timestamp")
    days = sorted(r[0] for r in readings.select(day).distinct().collect())
    late = (day == F.lit(days[1])) & (F.col("event_id") % 2 == 0)
    write_metrics_table(ocean_metrics_batch(readings.where(~late)), path)

    def files():
        rows = spark.read.parquet(path).select("window_date", F.col("_metadata.file_name")).distinct().collect()
        return {d: {f for e, f in rows if e == d} for d in {d for d, _ in rows}}

    before = files()
    dates = changed_dates(readings.where(late))
    assert dates == [days[1]]
    table = refresh_metrics_table(readings, path, dates)
    after = files()
    assert set(after) == set(before) and [d for d in before if before[d] != after[d]] == dates
    whole = ocean_metrics_batch(readings)
    key = ["window_start", "location", "depth_layer", "measurement_count", "gradient_qc_failures", "temp_max"]
    assert sorted(map(tuple, table.select(*key).collect())) == sorted(map(tuple, whole.select(*key).collect()))
    assert refresh_metrics_table(readings, path, []).count() == whole.count() and files() == after
    assert read_metrics_table(spark, path).columns == table.columns
    assert isinstance(dates[0], dt.date)
