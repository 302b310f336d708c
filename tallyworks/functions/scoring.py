"""A column slot for any batch model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_scores(
    df: DataFrame, text: str, make_predict_fn: Callable, labels: list[str], batch_size: int = 256
) -> DataFrame:
    """Adds one score column per label.

    ``make_predict_fn`` loads the model once per Python worker and returns a function from an array
    of texts to an array with one row per text and one column per label.
    """
    score = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    scored = df.withColumn("__scores", score(F.col(text)))
    return scored.withColumns({v: F.col("__scores")[i] for i, v in enumerate(labels)}).drop("__scores")
