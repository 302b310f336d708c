"""Splits, codes, fills and scaling ahead of a model."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.aggs import describe_texts
from tallyworks.operators.frame import distinct_codes
from tallyworks.operators.quantiles import exact_quantiles, long_values
from tallyworks.operators.scan import OrderedScan


def draw(key: Column, seed: int) -> Column:
    """Whole number 0 .. 2^32 - 1 from key and seed; the same on any partitioning."""
    text = F.concat_ws("-", key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def split(
    df: DataFrame, key: str, share: float = 0.3, seed: int = 0, by: str | None = None, name: str = "is_test",
    parts: int | None = None,
) -> DataFrame:
    """Marks the held-out rows: by hash, or with the same share of every class of ``by``."""
    if by is None:
        return df.withColumn(name, draw(F.col(key), seed) < F.lit(int(share * 2**32)))
    rows = df.withColumn("__draw", draw(F.col(key), seed))
    scan = OrderedScan(rows, [by], ["__draw", key], parts).row_number("__rn").with_group_size("__n")
    return scan.result().withColumn(name, F.col("__rn") <= F.lit(share) * F.col("__n")).drop("__draw", "__rn", "__n")


def folds(
    df: DataFrame, key: str, k: int, seed: int = 0, by: str | None = None, name: str = "fold", parts: int | None = None
) -> DataFrame:
    """Fold number 0 .. k - 1 by hash, or dealt out within every class of ``by``."""
    if by is None:
        return df.withColumn(name, (draw(F.col(key), seed) % k).cast("int"))
    rows = df.withColumn("__draw", draw(F.col(key), seed))
    rows = OrderedScan(rows, [by], ["__draw", key], parts).row_number("__rn").result()
    return rows.withColumn(name, ((F.col("__rn") - 1) % k).cast("int")).drop("__draw", "__rn")


def separate(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows to learn from and rows to predict, by whether the target is known."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull()).drop(target)


def dummies(df: DataFrame, cols: list[str], drop_first: bool = True, fit_on: DataFrame | None = None) -> DataFrame:
    """0/1 columns ``col_code`` in place of ``cols``; the alphabetically first code has none."""
    for c in cols:
        values = distinct_codes(fit_on if fit_on is not None else df, c)[int(drop_first):]
        df = df.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == v, F.lit(False)).cast("int") for v in values})
    return df.drop(*cols)


def code_map(df: DataFrame, col: str, parts: int | None = None) -> DataFrame:
    """``(value, code)``: codes count from 0 in the order of the values (numbers as numbers)."""
    values = df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct()
    numbered = OrderedScan(values, [], ["value"], parts).row_number("__rn").result()
    return numbered.select("value", (F.col("__rn") - 1).cast("int").alias("code"))


def codes(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Each column replaced by its code, -1 for a missing value; codes come from ``fit_on``."""
    for c in cols:
        table = code_map(fit_on if fit_on is not None else df, c, parts)
        df = df.join(table.withColumnRenamed("value", "__v"), F.col(c) == F.col("__v"), "left")
        df = df.withColumn(c, F.coalesce("code", F.lit(-1))).drop("__v", "code")
    return df


def fill_constants(df: DataFrame, cols: list[str], strategy: str) -> dict:
    """One number or text per column: its exact mean, median or most frequent value."""
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return row.asDict()
    if strategy == "median":
        rows = exact_quantiles(df, cols, [0.5]).collect()
        return {r["column"]: r["quantile"] for r in rows}
    if strategy == "most_frequent":
        return {r["column"]: r["top"] for r in describe_texts(df, cols).collect()}
    raise ValueError(f"unknown strategy {strategy}")


def impute(df: DataFrame, cols: list[str], strategy: str = "mean", fit_on: DataFrame | None = None) -> DataFrame:
    """Missing values replaced by a constant per column that is found on ``fit_on``."""
    found = fill_constants(fit_on if fit_on is not None else df, cols, strategy)
    kinds = dict(df.dtypes)
    whole = ("int", "bigint", "smallint", "tinyint")
    target = {c: "double" if strategy != "most_frequent" and kinds[c] in whole else kinds[c] for c in cols}
    return df.withColumns({c: F.coalesce(F.col(c).cast(target[c]), F.lit(found.get(c)).cast(target[c])) for c in cols})


class QuantileScaler:
    """Maps numbers to their rank among the fitted values, between 0 and 1.

    Up to ``points`` exact quantiles per column are kept; a value between two of them is placed in
    proportion, a repeated value in the middle of its range. Values outside go to 0 or 1.
    """

    def __init__(self, columns: list[str], points: int = 1000, parts: int | None = None):
        self.columns, self.points, self.parts = columns, points, parts
        self.marks: dict[str, list[tuple[float, float, float]]] = {}

    def fit(self, df: DataFrame) -> QuantileScaler:
        sizes = long_values(df, self.columns).groupBy("column").agg(F.count("value").alias("n")).collect()
        points = max(2, min(self.points, max(r["n"] for r in sizes)))
        shares = [i / (points - 1) for i in range(points)]
        # points x columns rows: bounded by the arguments, not by the data
        rows = exact_quantiles(df, self.columns, shares, parts=self.parts).collect()
        for c in self.columns:
            found = sorted((r["quantile"], r["share"]) for r in rows if r["column"] == c)
            marks: dict[float, tuple[float, float]] = {}
            for value, share in found:
                low, _ = marks.get(value, (share, share))
                marks[value] = (low, share)
            self.marks[c] = [(v, lo, hi) for v, (lo, hi) in sorted(marks.items())]
        return self

    def _scaled(self, c: str, place: Column) -> Column:
        value, low, high = (F.lit([m[i] for m in self.marks[c]]) for i in range(3))
        i = place.cast("int")  # number of marks that are not above the value
        here, top = F.col(c).cast("double"), len(self.marks[c])
        left, right = F.try_element_at(value, i), F.try_element_at(value, i + 1)
        start, end = F.try_element_at(high, i), F.try_element_at(low, i + 1)
        on_mark = (F.try_element_at(low, i) + start) / 2
        between = start + (end - start) * (here - left) / (right - left)
        return (
            F.when(F.col(c).isNull(), None)
            .when(i == top, 1.0)
            .when((i == 0) | (here == F.lit(self.marks[c][0][0])), 0.0)
            .when(here == left, on_mark)
            .otherwise(between)
        )

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns:
            edges = [-math.inf, *[m[0] for m in self.marks[c]], math.inf]
            place = Bucketizer(splits=edges, inputCol="__in", outputCol="__place", handleInvalid="keep")
            df = place.transform(df.withColumn("__in", F.col(c).cast("double")))
            df = df.withColumn(c, self._scaled(c, F.col("__place"))).drop("__in", "__place")
        return df


def prepared_estimator(
    estimator, numbers: list[str], categories: list[str] = (), strategy: str = "mean", one_hot: bool = True
) -> Pipeline:
    """Fill numbers, code categories (unknown ones stay apart), assemble, estimate.

    An unknown category has zeros in all known places.
    """
    filled = [f"{c}__filled" for c in numbers]
    stages = []
    if numbers:
        stages.append(Imputer(strategy=strategy, inputCols=numbers, outputCols=filled))
    inputs = filled
    if categories:
        indexed = [f"{c}__index" for c in categories]
        stages.append(
            StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        if one_hot:
            vectors = [f"{c}__vector" for c in categories]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=vectors, handleInvalid="keep", dropLast=True))
            inputs = [*filled, *vectors]
        else:
            inputs = [*filled, *indexed]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=[*stages, estimator])


def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
