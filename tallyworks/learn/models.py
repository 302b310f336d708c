"""Estimators with the settings the jobs start from. All of them train on Spark."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.learn.prep import assembler


def linear(label: str = "label") -> LinearRegression:
    return LinearRegression(labelCol=label)


def lasso(label: str = "label", alpha: float = 1.0) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False)


def elastic_net(label: str = "label", alpha: float = 1.0, l1_ratio: float = 0.5) -> LinearRegression:
    return LinearRegression(labelCol=label, regParam=alpha, elasticNetParam=l1_ratio, tol=1e-2, standardization=True)


def logistic(label: str = "label", rows: int | None = None, strength: float = 1.0, max_iter: int = 100) -> LogisticRegression:
    """Without ``rows`` no penalty; with it the squared penalty of strength C over that many rows."""
    penalty = 0.0 if rows is None else 1.0 / (strength * rows)
    return LogisticRegression(labelCol=label, regParam=penalty, maxIter=max_iter, standardization=False)


def decision_tree(label: str = "label", depth: int = 4) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth)


def random_forest(
    label: str = "label", trees: int = 90, depth: int = 9, min_leaf: int = 4, seed: int = 0, regression: bool = False
):
    kind, subset = (RandomForestRegressor, "all") if regression else (RandomForestClassifier, "sqrt")
    return kind(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy=subset, seed=seed
    )


def boosted_trees(
    label: str = "label", trees: int = 100, depth: int = 4, rate: float = 0.05, min_leaf: int = 1, share: float = 1.0,
    subset: str = "all", min_gain: float = 0.0, validation: str | None = None, seed: int = 0, regression: bool = False,
):
    """``validation`` names a boolean column: boosting stops when these rows improve no more."""
    kind = GBTRegressor if regression else GBTClassifier
    model = kind(
        labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, minInstancesPerNode=min_leaf, minInfoGain=min_gain,
        subsamplingRate=share, featureSubsetStrategy=subset, seed=seed, validationTol=0.001,
    )
    if validation:
        model.setValidationIndicatorCol(validation)
    return model


def fit(estimator, df: DataFrame, features: list[str]):
    """Assembles the features and fits."""
    return Pipeline(stages=[assembler(features), estimator]).fit(df)


def with_probability(model, df: DataFrame) -> DataFrame:
    """Predictions with ``score``, the probability of class 1."""
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


class RidgeClassifier:
    """Squared-penalty regression on -1 / 1; the sign of the answer is the class."""

    def __init__(self, label: str, features: list[str], alpha: float = 1.0):
        self.label, self.features, self.alpha = label, features, alpha

    def fit(self, df: DataFrame) -> RidgeClassifier:
        signed = df.withColumn("__sign", F.col(self.label) * 2.0 - 1.0)
        penalty = self.alpha / max(df.count(), 1)
        estimator = LinearRegression(labelCol="__sign", regParam=penalty, elasticNetParam=0.0, standardization=False)
        self.model = fit(estimator, signed, self.features)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df).withColumnRenamed("prediction", "decision")
        return out.withColumn("prediction", (F.col("decision") > 0).cast("double"))


def score(model, df: DataFrame, key: str, name: str = "prediction") -> DataFrame:
    """Key and prediction of every row, ready to be written."""
    return model.transform(df).select(key, F.col("prediction").alias(name))
