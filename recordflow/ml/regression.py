"""Days-to-close regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from recordflow.operators.features import with_split


def _with_vector(features: DataFrame) -> DataFrame:
    return features.withColumn("features", array_to_vector(F.col("x").cast("array<double>")))


def fit(
    features: DataFrame, *, id_name: str = "Id", rounds: int = 20, depth: int = 5, seed: int = 42
) -> PipelineModel:
    """Fit on the training share of (id, x, y) by absolute error; rows without ``y`` teach nothing."""
    train = with_split(features.filter("y is not null"), id_name).filter("split = 'train'")
    trees = GBTRegressor(
        featuresCol="features", labelCol="y", lossType="absolute", maxIter=rounds, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[trees]).fit(_with_vector(train))


def predict(model: PipelineModel, features: DataFrame, id_name: str = "Id") -> DataFrame:
    """(id, x, prediction) for every row."""
    return model.transform(_with_vector(features)).select(id_name, "x", "prediction")


def holdout_errors(model: PipelineModel, features: DataFrame, id_name: str = "Id") -> DataFrame:
    """Mean absolute error on the rows held out, of the model and of the training median."""
    known = with_split(features.filter("y is not null"), id_name)
    median = known.filter("split = 'train'").agg(F.percentile_approx("y", 0.5, 10000)).first()[0]
    test = _with_vector(known.filter("split = 'test'"))
    scored = model.transform(test)
    return scored.agg(
        F.avg(F.abs(F.col("prediction") - F.col("y"))).alias("model_mae"),
        F.avg(F.abs(F.col("y") - F.lit(median))).alias("median_mae"),
        F.count(F.lit(1)).alias("n"),
    )
