"""How a model treats groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.learn.explain import tree_importance
from tallyworks.learn.models import fit
from tallyworks.operators.aggs import confusion

RATES = ["accuracy", "fnr", "fpr", "tpr", "tnr", "ppv", "npv"]


def group_audit(df: DataFrame, label: str, pred: str, member: Column, digits: int = 2) -> DataFrame:
    """Confusion counts and rates of the protected group and of the rest.

    The flag is carried along as an unused column, so nothing is joined back after prediction.
    """
    flagged = df.withColumn("protected", F.coalesce(member, F.lit(False)))
    return confusion(flagged, F.col(label), F.col(pred), ["protected"], digits)


def audit_without(
    estimator: Callable[[], object], train: DataFrame, test: DataFrame, label: str, features: list[str], column: str, member: Column
) -> DataFrame:
    """The same model fitted with and without a column: rates per group side by side."""
    sides = []
    for name, used in (("with", features), ("without", [f for f in features if f != column])):
        answered = fit(estimator(), train, used).transform(test)
        rates = group_audit(answered, label, "prediction", member, 4)
        sides.append(rates.select("protected", *[F.col(r).alias(f"{r}_{name}") for r in RATES]))
    both = sides[0].join(sides[1], "protected")
    return both.withColumns({f"{r}_change": F.col(f"{r}_without") - F.col(f"{r}_with") for r in RATES})


def proxy_test(
    estimator: Callable[[], object], train: DataFrame, test: DataFrame, member: Column, features: list[str]
) -> tuple[DataFrame, DataFrame]:
    """How well the other features tell the protected group: rates, and which features do it."""
    target = F.coalesce(member, F.lit(False)).cast("int")
    model = fit(estimator(), train.withColumn("proxy", target), features)
    answered = model.transform(test.withColumn("proxy", target))
    return confusion(answered, F.col("proxy"), F.col("prediction"), digits=4), tree_importance(model, features, train)
