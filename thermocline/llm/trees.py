"""Tree classifiers of Spark ML on plain numeric columns, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[DataFrame], DataFrame]


def _share(rows: DataFrame, label: str) -> tuple[float, int]:
    r = rows.agg(F.avg(label).alias("p"), F.countDistinct(label).alias("n")).first()
    return float(r.p or 0.0), r.n


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="__features", handleInvalid="keep").transform(df)


def _fit(classifier, train: DataFrame, features: list[str], label: str) -> Scorer:
    model = classifier.setFeaturesCol("__features").setLabelCol("__label").fit(_vectors(train, features).withColumn("__label", F.col(label).cast("double")))
    model.setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__class")

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(_vectors(df, features)).withColumn("score", vector_to_array("__p")[1])
        return out.drop("__features", "__p", "__raw", "__class")

    return score


def boosted_trees(train: DataFrame, features: list[str], label: str = "label", rounds: int = 20, depth: int = 3, seed: int = 11) -> Scorer:
    """Fits gradient-boosted trees on the small table ``train``; the result adds the column ``score``, the
    probability of label 1. Without two classes the score is the share of label 1 (0 without rows)."""
    p, classes = _share(train, label)
    if classes < 2:
        return lambda df: df.withColumn("score", F.lit(p))
    return _fit(GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, cacheNodeIds=False), train, features, label)


def random_forest(train: DataFrame, features: list[str], label: str = "label", trees: int = 40, depth: int = 6, seed: int = 11) -> Scorer:
    """As boosted_trees, with a random forest."""
    p, classes = _share(train, label)
    if classes < 2:
        return lambda df: df.withColumn("score", F.lit(p))
    return _fit(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed), train, features, label)


def calibrated(score: Scorer, held: DataFrame, label: str = "label") -> Scorer:
    """``score`` followed by an isotonic fit of the labels of ``held``, rows that ``score`` was not fitted on."""
    if _share(held, label)[1] < 2:
        return score
    iso = IsotonicRegression(featuresCol="score", labelCol="__label", predictionCol="__cal").fit(score(held).withColumn("__label", F.col(label).cast("double")))
    return lambda df: iso.transform(score(df)).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__cal")))).drop("__cal")
