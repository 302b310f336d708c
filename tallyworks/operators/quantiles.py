"""Exact quantiles of columns of any size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.scan import OrderedScan
from tallyworks.session import cut_lineage


def long_values(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """One row (column, value) per cell of numeric columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keys, F.inline(F.array(*cells)))


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("value").isNotNull() & ~F.isnan("value"))


def _by_rank(
    counted: DataFrame, by: list[str], wanted: Column, total: Column | None, before: Column, parts: int | None
) -> DataFrame:
    """Quantiles of counted values ``(by, value, n)``.

    ``wanted`` is the array of shares to look for on a row, ``before`` the number of values that
    come ahead of the counted ones of its group, ``total`` the size of the whole group (the counted
    values are all there is where it is missing).
    """
    scan = OrderedScan(counted, by, ["value"], parts).running_sum("n", "__upto")
    if total is None:
        scan.group_sum(F.col("n"), "__total")
    else:
        scan.df = scan.df.withColumn("__total", total)
    upto = before + F.col("__upto")

    def holds(place: Column) -> Column:
        return (place >= upto - F.col("n")) & (place < upto)

    def place_of(share: Column) -> Column:
        return share * (F.col("__total") - 1)

    on_row = F.filter(wanted, lambda s: holds(F.floor(place_of(s))) | holds(F.ceil(place_of(s))))
    hits = scan.result().withColumn("share", F.explode(on_row))
    place = place_of(F.col("share"))
    low = F.max(F.when(holds(F.floor(place)), F.col("value")))
    high = F.max(F.when(holds(F.ceil(place)), F.col("value")))
    names = [c for c in by if not c.startswith("__")]
    return hits.groupBy(*names, "share").agg((low + (high - low) * F.max(place - F.floor(place))).alias("quantile"))


def _full_scan(df: DataFrame, columns: list[str], shares: list[float], keys: list[str], parts: int | None) -> DataFrame:
    """All values counted and put in order."""
    by = [*keys, "column"]
    counted = _known(long_values(df, columns, keys)).groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    return _by_rank(counted, by, F.lit(shares), None, F.lit(0), parts)


_ACCURACY = 10_000


def _brackets(df: DataFrame, columns: list[str], shares: list[float]) -> dict[tuple[str, float], tuple] | None:
    """Per column and share: values that enclose the quantile, and how many values lie below them.

    The enclosing values come from ``percentile_approx``; exact counts prove that they enclose it.
    None where they do not (few values, or none).
    """
    margin = 3 / _ACCURACY
    ends = [max(0.0, s - margin) for s in shares] + [min(1.0, s + margin) for s in shares]
    num = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    found = df.agg(*[F.percentile_approx(num[c], ends, _ACCURACY).alias(c) for c in columns]).first()
    if any(found[c] is None for c in columns):
        return None
    span = {(c, s): (found[c][i], found[c][i + len(shares)]) for c in columns for i, s in enumerate(shares)}
    sums = [F.count(num[c]).alias(f"n_{j}") for j, c in enumerate(columns)]
    for i, ((c, _), (lo, hi)) in enumerate(span.items()):
        sums += [F.count_if(num[c] < lo).alias(f"below_{i}"), F.count_if(num[c] <= hi).alias(f"upto_{i}")]
    counts = df.agg(*sums).first()
    out = {}
    for i, ((c, s), (lo, hi)) in enumerate(span.items()):
        total = counts[f"n_{columns.index(c)}"]
        place = s * (total - 1)
        if not counts[f"below_{i}"] <= math.floor(place) or not math.ceil(place) < counts[f"upto_{i}"]:
            return None
        out[(c, s)] = (lo, hi, counts[f"below_{i}"], counts[f"upto_{i}"], total)
    return out


def exact_quantiles(
    df: DataFrame, columns: list[str], shares: list[float], keys: list[str] = (), parts: int | None = None
) -> DataFrame:
    """Rows (keys, column, share, quantile), exact, with linear interpolation between neighbours.

    A few quantiles of whole columns are found by two aggregates that enclose them, and an ordering
    of the few values in between: nothing large is shuffled. Many quantiles, or those of groups,
    come from an ``OrderedScan`` of the counted values. Spark's ``percentile`` would hold all values
    of a group in one task.
    """
    shares = [float(s) for s in shares]
    found = _brackets(df, columns, shares) if not keys and len(shares) <= 20 else None
    if found is None:
        return _full_scan(df, columns, shares, list(keys), parts)
    # columns x shares literals, bounded by the arguments
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.lit(s).alias("__share"), F.lit(below).alias("__below"), F.lit(total).alias("__n"),
            F.when(F.col(c).cast("double").between(lo, hi), F.col(c).cast("double")).alias("value"),
        )
        for (c, s), (lo, hi, below, _, total) in found.items()
    ]
    near = df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    by = ["column", "__share", "__below", "__n"]
    counted = near.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    return _by_rank(counted, by, F.array("__share"), F.col("__n"), F.col("__below"), parts)


def wide_quantiles(quantiles: DataFrame, names: dict[float, str], keys: list[str]) -> DataFrame:
    """One row per key with one column per share."""
    return quantiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("share") == s, F.col("quantile"))).alias(n) for s, n in names.items()]
    )
