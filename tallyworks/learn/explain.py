"""What a model does with its features."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import with_grid
from tallyworks.session import cut_lineage


def _last_stage(model):
    return model.stages[-1] if hasattr(model, "stages") else model


def coef_importance(model, features: list[str], df: DataFrame) -> DataFrame:
    """Features by the size of their coefficient. ``df`` only lends its session."""
    values = [float(v) for v in _last_stage(model).coefficients]
    rows = [(f, v, abs(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def tree_importance(model, features: list[str], df: DataFrame) -> DataFrame:
    """Features by their share of the impurity removed by all splits."""
    values = _last_stage(model).featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def grid_values(df: DataFrame, feature: str, points: int = 50) -> list[float]:
    """The distinct values of a feature if there are at most ``points``, else evenly spaced ones."""
    found = df.select(F.col(feature).cast("double")).where(F.col(feature).isNotNull()).distinct().limit(points + 1).collect()
    if len(found) <= points:
        return sorted(r[0] for r in found)
    ends = df.agg(F.min(feature).cast("double").alias("lo"), F.max(feature).cast("double").alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) / (points - 1)
    return [ends["lo"] + i * step for i in range(points)]


def partial_dependence(model, df: DataFrame, features: list[str], feature: str, output: str = "prediction", points: int = 50) -> DataFrame:
    """Mean answer of a model when one feature is set to each value of a grid.

    Rows that agree in all other features are counted first and answered once. A row becomes at
    most ``points`` rows inside its task; only one sum per grid value is shuffled.
    """
    rest = [f for f in features if f != feature]
    kinds = df.groupBy(*rest).agg(F.count(F.lit(1)).alias("__n"))
    asked = with_grid(kinds, feature, grid_values(df, feature, points))
    answered = model.transform(asked)
    mean = F.sum(F.col(output) * F.col("__n")) / F.sum("__n")
    return answered.groupBy(F.col(feature).alias("value")).agg(mean.alias("mean_answer"))


def linear_shapley(df: DataFrame, key: str, coefficients: dict[str, float], background: DataFrame | None = None) -> DataFrame:
    """Contribution of every feature to a linear answer: coefficient times distance from the mean."""
    base = (background if background is not None else df).agg(*[F.avg(f).alias(f) for f in coefficients]).first()
    return df.select(key, *[(F.lit(float(c)) * (F.col(f) - F.lit(float(base[f])))).alias(f) for f, c in coefficients.items()])


def mean_absolute(contributions: DataFrame, features: list[str]) -> DataFrame:
    """Features by the mean size of their contribution."""
    wide = contributions.agg(*[F.avg(F.abs(f)).alias(f) for f in features])
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features]
    return wide.select(F.inline(F.array(*cells)))


def sampled_shapley(
    model, df: DataFrame, key: str, features: list[str], background: DataFrame, order: list[str],
    permutations: int = 10, seed: int = 0, output: str = "prediction",
) -> DataFrame:
    """Shapley values of any model by sampled feature orders.

    For each order one background row is changed into the explained row, one feature after the
    other; a feature's value is the mean change of the answer at its turn. Each row becomes
    ``permutations`` times (features + 1) rows inside its task, all answered by one ``transform``.
    The values of a row add up to its answer minus ``base``, the mean answer of the background
    rows used: ``permutations`` rows drawn from the whole background by a hash of ``order`` and seed.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in order]))
    used = [r.asDict() for r in background.select(*order, *features).orderBy(draw, *order).limit(permutations).collect()]
    rng = random.Random(seed)
    steps = []
    for p in range(permutations):
        turn = rng.sample(features, len(features))
        row = used[p % len(used)]
        for k in range(len(features) + 1):
            own = set(turn[:k])
            steps.append(
                F.struct(
                    F.array(*[F.lit(f in own) for f in features]).alias("own"),
                    F.array(*[F.lit(float(row[f])) for f in features]).alias("other"),
                    F.lit(turn[k - 1] if k else None).cast("string").alias("gain"),
                    F.lit(turn[k] if k < len(features) else None).cast("string").alias("loss"),
                )
            )
    mixed = df.select(key, *features).withColumn("__s", F.explode(F.array(*steps)))
    mixed = mixed.withColumns(
        {
            f: F.when(F.col("__s.own")[i], F.col(f).cast("double")).otherwise(F.col("__s.other")[i])
            for i, f in enumerate(features)
        }
    )
    answered = model.transform(mixed)
    answer = F.col(output)

    def share(f: str):
        up = F.when(F.col("__s.gain") == f, answer).otherwise(0.0)
        down = F.when(F.col("__s.loss") == f, answer).otherwise(0.0)
        return F.sum(up - down) / permutations

    base = F.sum(F.when(F.col("__s.gain").isNull(), answer)) / permutations
    own = F.sum(F.when(F.col("__s.loss").isNull(), answer)) / permutations
    return answered.groupBy(key).agg(*[share(f).alias(f) for f in features], base.alias("base"), own.alias("answer"))


# --- exact values of trees


@dataclass
class Leaf:
    """A leaf of one tree: splits ``(feature number, threshold, goes left)`` from the root down, answer and the weight of its tree."""

    tree: int
    path: list[tuple[int, float, bool]]
    value: float
    weight: float = 1.0

    def interval(self, feature: int) -> tuple[float, float]:
        """Values above the first and up to the second reach the leaf."""
        low, high = -math.inf, math.inf
        for f, threshold, left in self.path:
            if f == feature:
                low, high = (low, min(high, threshold)) if left else (max(low, threshold), high)
        return low, high


def tree_leaves(model) -> list[Leaf]:
    """Leaves of a fitted tree, forest or boosted regression; of classifiers (trees and forests) the share of class 1."""
    stage = _last_stage(model)
    trees = list(stage.trees) if hasattr(stage, "trees") else [stage]
    weights = list(stage.treeWeights) if hasattr(stage, "treeWeights") else [1.0]
    boosted = type(stage).__name__.startswith("GBT")
    if boosted and "Classif" in type(stage).__name__:
        raise ValueError("a boosted classifier's probability is no sum of leaves")
    total = 1.0 if boosted else sum(weights)
    leaves: list[Leaf] = []

    def walk(tree: int, node, path: list, weight: float) -> None:
        if node.getClass().getSimpleName() == "LeafNode":
            value = float(node.prediction())
            if "Classif" in type(stage).__name__:
                stats = list(node.impurityStats().stats())
                value = stats[1] / sum(stats)
            leaves.append(Leaf(tree, path, value, weight))
            return
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only splits at a threshold can be explained")
        feature, threshold = split.featureIndex(), split.threshold()
        walk(tree, node.leftChild(), [*path, (feature, threshold, True)], weight)
        walk(tree, node.rightChild(), [*path, (feature, threshold, False)], weight)

    for i, (tree, weight) in enumerate(zip(trees, weights)):
        walk(i, tree._call_java("rootNode"), [], float(weight) / total)
    return leaves


def _conditions(leaves: list[Leaf], shares: list[dict[int, float]] | None = None) -> Column:
    """Array of leaves as structs ``v`` and ``c``, the latter an array of feature, interval and share."""

    def bound(x: float) -> Column:
        return F.lit(float(x))

    def of(leaf: Leaf, at: int) -> Column:
        rows = []
        for f in dict.fromkeys(f for f, _, _ in leaf.path):
            low, high = leaf.interval(f)
            rows.append(F.struct(F.lit(f).alias("f"), bound(low).alias("low"), bound(high).alias("high"), bound(shares[at][f] if shares else 0.0).alias("z")))
        empty = F.array().cast("array<struct<f:int,low:double,high:double,z:double>>")
        return F.struct(bound(leaf.value * leaf.weight).alias("v"), (F.array(*rows) if rows else empty).alias("c"))

    return F.array(*[of(leaf, i) for i, leaf in enumerate(leaves)])


def _holds(c: Column, values: Column) -> Column:
    x = F.get(values, c["f"])
    return (x > c["low"]) & (x <= c["high"])


# cells that the thresholds may cut the features into before rows are looked at one by one
_MOST_CELLS = 100_000


def _cell(leaves: list[Leaf], features: list[str]) -> Column | None:
    """Number of the cell of a row: rows of one cell lie on the same side of every split. None if there may be too many cells.

    A missing value, one that is no number and one below all numbers are on no side, so each has a place of its own.
    """
    cuts = [sorted({t for leaf in leaves for f, t, _ in leaf.path if f == i}) for i in range(len(features))]
    if math.prod(len(c) + 4 for c in cuts) > _MOST_CELLS:
        return None
    number = F.lit(0).cast("long")
    for f, own in zip(features, cuts):
        x = F.col(f).cast("double")
        above = sum([(x > float(t)).cast("int") for t in own], F.lit(3))
        place = F.when(x.isNull(), 0).when(F.isnan(x), 1).when(x == float("-inf"), 2).otherwise(above)
        number = number * (len(own) + 4) + place
    return number


def _cells(df: DataFrame, cell: Column, features: list[str]) -> DataFrame:
    """Cells that occur ``(__cell, __n, features)`` with their rows and the values of any of them."""
    rows = df.select(cell.alias("__cell"), *[F.col(f).cast("double").alias(f) for f in features])
    return rows.groupBy("__cell").agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(f).alias(f) for f in features])


def leaf_shares(leaves: list[Leaf], background: DataFrame, features: list[str]) -> tuple[list[dict[int, float]], list[float]]:
    """Per leaf and feature on its path the share of background rows that take the leaf's side at the splits on that feature,
    each among the rows that reach the split; and the share of all rows that reach the leaf.

    One pass: a row counts once per tree, and only counts of leaves are shuffled; rows of one cell are counted before they are looked at.
    """
    cell = _cell(leaves, features)
    background = background.withColumn("__n", F.lit(1)) if cell is None else _cells(background, cell, features)
    values = F.array(*[F.col(f).cast("double") for f in features])
    reached = F.transform(_conditions(leaves), lambda leaf, i: F.when(F.forall(leaf["c"], lambda c: _holds(c, values)), i))
    rows = background.select("__n", F.explode(F.array_compact(reached)).alias("leaf")).groupBy("leaf").agg(F.sum("__n").alias("count")).collect()
    counts = {r["leaf"]: r["count"] for r in rows}
    below: dict[tuple, int] = {}
    for i, leaf in enumerate(leaves):
        for k in range(len(leaf.path) + 1):
            key = (leaf.tree, *leaf.path[:k])
            below[key] = below.get(key, 0) + counts.get(i, 0)
    shares, whole = [], []
    for i, leaf in enumerate(leaves):
        found: dict[int, float] = {}
        for k, (f, _, _) in enumerate(leaf.path):
            above = below[(leaf.tree, *leaf.path[:k])]
            found[f] = found.get(f, 1.0) * (below[(leaf.tree, *leaf.path[: k + 1])] / above if above else 0.0)
        shares.append(found)
        total = below[(leaf.tree,)]
        whole.append(counts.get(i, 0) / total if total else 0.0)
    return shares, whole


def leaf_shapley(leaves: list[Leaf], df: DataFrame, key: list[str], features: list[str], background: DataFrame) -> DataFrame:
    """Exact Shapley values of a sum of trees: ``key``, one column per feature, ``base`` and ``answer``.

    A feature that is not known follows both sides of a split by their shares in ``background``. A leaf with d features on its path
    asks ``o`` of each (1 if the row lies in its interval) and has the share ``z``; over all orders of these d features, feature f gets
    value * (o_f - z_f) * sum over k of k! (d - 1 - k)! / d! times the coefficient of t^k in the product of (z + o t) over the others.
    That polynomial grows feature by feature, so a leaf costs d^2 steps and no order or subset is listed.
    ``base`` is the mean answer over the whole background, and the values of a row add up to its answer minus ``base``.

    The values depend on the cell of a row only. While the thresholds make few cells, each cell is explained once and its rows look it up.
    """
    cell = _cell(leaves, features)
    if cell is not None:
        explained = cut_lineage(_leaf_values(leaves, _cells(df, cell, features), ["__cell"], features, background))
        return df.select(*key, cell.alias("__cell")).join(explained, "__cell").drop("__cell")
    return _leaf_values(leaves, df, key, features, background)


def _leaf_values(leaves: list[Leaf], df: DataFrame, key: list[str], features: list[str], background: DataFrame) -> DataFrame:
    """``leaf_shapley`` row by row."""
    shares, whole = leaf_shares(leaves, background, features)
    base = sum(leaf.value * leaf.weight * n for leaf, n in zip(leaves, whole))
    deepest = max([len(s) for s in shares] + [1])
    weights = [[math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)] for d in range(1, deepest + 1)]
    table = F.array(*[F.array(*[F.lit(w) for w in row]) for row in weights])
    number = lambda flag: flag.cast("double")
    rows = df.select(*key, F.array(*[F.col(f).cast("double") for f in features]).alias("__x"), _conditions(leaves, shares).alias("__l"))
    values = F.col("__x")

    def grown(p: Column, c: Column) -> Column:
        at = lambda k: F.coalesce(F.get(p, k), F.lit(0.0))
        return F.transform(F.sequence(F.lit(0), F.size(p)), lambda k: at(k) * c["z"] + at(k - 1) * number(_holds(c, values)))

    def share_of(leaf: Column, f: int) -> Column:
        mine = F.filter(leaf["c"], lambda c: c["f"] == f)[0]
        others = F.filter(leaf["c"], lambda c: c["f"] != f)
        # weights of the orders times the coefficients
        weighted = lambda p: F.aggregate(F.zip_with(p, F.get(table, F.size(others)), lambda a, w: a * w), F.lit(0.0), lambda s, x: s + x)
        total = F.aggregate(others, F.array(F.lit(1.0)), grown, weighted)
        return F.when(F.exists(leaf["c"], lambda c: c["f"] == f), leaf["v"] * (number(_holds(mine, values)) - mine["z"]) * total).otherwise(0.0)

    add = lambda body: F.aggregate("__l", F.lit(0.0), lambda s, leaf: s + body(leaf))
    reached = lambda leaf: F.when(F.forall(leaf["c"], lambda c: _holds(c, values)), leaf["v"]).otherwise(0.0)
    return rows.select(*key, *[add(lambda leaf, i=i: share_of(leaf, i)).alias(f) for i, f in enumerate(features)], F.lit(base).alias("base"), add(reached).alias("answer"))


def tree_shapley(model, df: DataFrame, key: list[str], features: list[str], background: DataFrame) -> DataFrame:
    """Exact Shapley values of a fitted tree, forest or boosted regression; see ``leaf_shapley``."""
    return leaf_shapley(tree_leaves(model), df, key, features, background)
