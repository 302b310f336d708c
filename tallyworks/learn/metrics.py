"""Model quality as plain aggregates and running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.scan import OrderedScan
from tallyworks.session import cut_lineage


def r2(df: DataFrame, label: Column, pred: Column, by: list[str] = ()) -> DataFrame:
    """Share of explained variance, in one pass."""
    sides = F.sum((label - pred) * (label - pred)), F.var_pop(label) * F.count(label)
    return df.where(label.isNotNull() & pred.isNotNull()).groupBy(*by).agg((1 - F.try_divide(*sides)).alias("r2"))


def accuracy(df: DataFrame, label: Column, pred: Column, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((label == pred).cast("double")).alias("accuracy"))


def _by_score(df: DataFrame, label: str, score: str, parts: int | None) -> DataFrame:
    """One row per distinct score, highest first: positives and negatives at it, down to it, in all.

    Equal scores are counted before they are ordered. The counts are stored, so a model behind the
    scores answers once. ``__down`` orders from high to low.
    """
    counted = cut_lineage(
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy((-F.col(score).cast("double")).alias("__down"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    scan = OrderedScan(counted, [], ["__down"], parts).running_sum("pos", "tp").running_sum("neg", "fp")
    scan.group_sum(F.col("pos"), "positives").group_sum(F.col("neg"), "negatives")
    return scan.result().withColumn("threshold", -F.col("__down"))


def roc(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """Rates at each distinct score taken as threshold; the point (0, 0) is not listed."""
    steps = _by_score(df, label, score, parts)
    return steps.select(
        "threshold", F.try_divide("tp", "positives").alias("tpr"), F.try_divide("fp", "negatives").alias("fpr")
    )


def auc(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """Area under the curve: share of (positive, negative) pairs in the right order, ties half.

    Scores may be probabilities or hard labels.
    """
    steps = _by_score(df, label, score, parts)
    # negatives below a score are those not yet met on the way down
    wins = F.col("neg") * (F.col("tp") - F.col("pos") + 0.5 * F.col("pos"))
    return steps.agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def gini(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    return auc(df, label, score, parts).select((2 * F.col("auc") - 1).alias("gini"))


def auc_pr(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """Area under precision over recall: precision at each score weighted by the recall gained there."""
    steps = _by_score(df, label, score, parts)
    gained = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return steps.agg(F.try_divide(F.sum(gained), F.sum("pos").cast("double")).alias("auc_pr"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support of every class, from the cross table of both columns."""
    pairs = df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("guess")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"),
                    F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("guess").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    hits = F.col("hits")
    return sums.select(
        "class",
        ratio(hits, F.col("guessed")).alias("precision"),
        ratio(hits, F.col("support")).alias("recall"),
        ratio(2 * hits, F.col("guessed") + F.col("support")).alias("f1"),
        "support",
    )
