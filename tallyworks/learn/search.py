"""Parameter search by cross validation."""

from __future__ import annotations

import random
from itertools import product

from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession

ParamMap = dict[Param, object]


def grid(estimator, values: dict[str, list]) -> list[ParamMap]:
    """All combinations of parameter values."""
    names = list(values)
    return [
        {estimator.getParam(n): v for n, v in zip(names, combination)} for combination in product(*[values[n] for n in names])
    ]


def draws(estimator, values: dict[str, list], n: int, seed: int) -> list[ParamMap]:
    """``n`` different combinations drawn at random (all of them if there are fewer)."""
    every = grid(estimator, values)
    return random.Random(seed).sample(every, min(n, len(every)))


def grid_search(
    estimator, maps: list[ParamMap], df: DataFrame, evaluator, folds: int, fold_col: str, parallelism: int = 4
) -> CrossValidatorModel:
    """Fits every combination on all folds but one and keeps the best mean score.

    Folds come from a column made by ``prep.folds``, so they do not depend on the partitioning.
    """
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol=fold_col, parallelism=parallelism
    )
    return cv.fit(df)


def _best(model: CrossValidatorModel, evaluator) -> int:
    pick = max if evaluator.isLargerBetter() else min
    return model.avgMetrics.index(pick(model.avgMetrics))


def tune_in_steps(
    estimator, steps: list[dict[str, list]], df: DataFrame, evaluator, folds: int, fold_col: str, parallelism: int = 4
) -> tuple[object, list[tuple[ParamMap, float]]]:
    """One group of parameters after the other; the best values are kept for the next group."""
    tried: list[tuple[ParamMap, float]] = []
    for values in steps:
        maps = grid(estimator, values)
        model = grid_search(estimator, maps, df, evaluator, folds, fold_col, parallelism)
        tried += list(zip(maps, model.avgMetrics))
        estimator = estimator.copy(maps[_best(model, evaluator)])
    return estimator, tried


def results(spark: SparkSession, tried: list[tuple[ParamMap, float]]) -> DataFrame:
    """One row per combination with its mean score and rank."""
    ordered = sorted(range(len(tried)), key=lambda i: -tried[i][1])
    rank = {i: r + 1 for r, i in enumerate(ordered)}
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(s), rank[i])
        for i, (m, s) in enumerate(tried)
    ]
    return spark.createDataFrame(rows, "setting int, params string, mean_score double, rank int")


def cv_results(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    return results(spark, list(zip(model.getEstimatorParamMaps(), model.avgMetrics)))
