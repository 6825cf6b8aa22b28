"""M1-M5: feature assembly and gradient-boosted-tree regression with Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocline.session import checkpoint_root, materialize

AIR_FEATURES = ["avg_co2", "avg_temp", "avg_humidity", "max_pm25"]
AIR_LABEL = "impact_score"
OCEAN_FEATURES = ["temp_avg", "salinity_avg", "oxygen_avg", "ph_avg"]
OCEAN_LABEL = "oxygen_saturation_avg"


def feature_assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    """M1: rows with a NULL feature are skipped rather than failing the job."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def gbt_pipeline(
    features: Sequence[str], label: str, seed: int = 42, max_iter: int = 20, max_depth: int = 5
) -> Pipeline:
    """M2 + M3: assembler -> GBT regressor, returned unfitted."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, seed=seed, maxIter=max_iter, maxDepth=max_depth)
    return Pipeline(stages=[feature_assembler(features), gbt])


def split_flag(keys: Sequence[str], test_percent: int = 20) -> Column:
    """Deterministic train/test assignment from the MD5 of the row's keys as text (stable
    across runs and partitionings, unlike ``randomSplit``, and the same in any SQL engine)."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 100 < F.lit(test_percent)


def tree_rows(model: PipelineModel) -> DataFrame:
    """The fitted trees as rows, one a node: tree, weight, node, feature (null: a leaf), threshold, left, right and value.
    Values at most the threshold go left. Read from the model as Spark ML writes it."""
    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_root(spark)}/thermocline/model-{uuid.uuid4().hex}"
    model.stages[-1].write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    inner = F.col("split.featureIndex") >= 0
    rows = nodes.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"), F.col("prediction").alias("value"),
    )
    return rows.join(weights, "tree")


def tree_prediction(rows: DataFrame, features: Sequence[str]) -> Column:
    """The ensemble of ``tree_rows`` as one expression over the feature columns: nested conditions a tree. Their number
    is bounded by the model's parameters (trees times 2 ** (depth + 1))."""
    trees: dict[int, dict] = {}
    for r in rows.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r

    def below(nodes: dict, k: int) -> Column:
        n = nodes[k]
        if n["feature"] is None:
            return F.lit(float(n["value"]))
        here = F.col(features[n["feature"]]).cast("double") <= F.lit(float(n["threshold"]))
        return F.when(here, below(nodes, n["left"])).otherwise(below(nodes, n["right"]))

    total = F.lit(0.0)
    for _, nodes in sorted(trees.items()):
        total = total + F.lit(float(nodes[0]["weight"])) * below(nodes, 0)
    return total


def fit_and_score(
    pipeline: Pipeline, df: DataFrame, label: str, keys: Sequence[str], test_percent: int = 20
) -> tuple[PipelineModel, DataFrame, dict[str, float]]:
    """M4: fit on the training part, predict every row, evaluate on the test part.

    Returns (model, predictions of all rows with an ``is_test`` flag, metrics). The input is written once: fitting,
    predicting and both evaluations read that copy.
    """
    tagged = materialize(df.withColumn("is_test", split_flag(keys, test_percent)), "model-rows")
    model = pipeline.fit(tagged.filter(~F.col("is_test")))
    predictions = model.transform(tagged)
    test = predictions.filter("is_test")
    metrics = {
        m: RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=m).evaluate(test)
        for m in ("rmse", "r2")
    }
    return model, predictions, metrics


#: A prediction by the exported trees differs from the model's own by rounding alone.
TOLERANCE = 1e-9


def with_checked_predictions(model: PipelineModel, predictions: DataFrame, features: Sequence[str]) -> DataFrame:
    """``predictions`` with tree_prediction (by the exported trees) and same_prediction (both agree)."""
    by_trees = predictions.withColumn("tree_prediction", tree_prediction(tree_rows(model), features))
    apart = F.abs(F.col("prediction") - F.col("tree_prediction"))
    return by_trees.withColumn("same_prediction", apart <= TOLERANCE * F.greatest(F.lit(1.0), F.abs("prediction")))
