"""Joins.

No join carries a broadcast hint. Spark broadcasts a side while its estimated or measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution splits hot keys of the other
joins, so a dimension may grow without breaking the job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.scan import OrderedScan


def join_suffixed(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Join in which other columns of the same name get a side suffix."""
    both = [c for c in left.columns if c in right.columns and c not in on]
    return left.withColumnsRenamed({c: c + suffixes[0] for c in both}).join(
        right.withColumnsRenamed({c: c + suffixes[1] for c in both}), on, how
    )


def fanout(dim: DataFrame, on: list[str]) -> DataFrame:
    """Keys by which a join with ``dim`` multiplies rows, with the factor."""
    return dim.groupBy(*on).agg(F.count(F.lit(1)).alias("factor")).where("factor > 1")


def multiplying_left_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a right side that may hold many rows per key.

    Adaptive execution can split a hot key of either side of an inner join, but not of the right
    side of a left join. So the matches are an inner join, and the rows without a match are found
    against the distinct keys, which are reduced before they travel.
    """
    lonely = left.join(right.select(*on).distinct(), on, "left_anti")
    return left.join(right, on).unionByName(lonely, allowMissingColumns=True)


def align(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """Columns side by side by row key."""
    return reduce(lambda a, b: a.join(b, key), frames)


def one_per_key(dim: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """First value of each key."""
    return dim.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def lookup_or_self(
    df: DataFrame, col: str, dim: DataFrame, key: str, value: str, order: list[str], name: str | None = None
) -> DataFrame:
    """``col`` translated by ``dim`` (first entry of a key wins), unknown values kept."""
    table = one_per_key(dim, key, value, order).withColumnsRenamed({key: "__k", value: "__v"})
    return df.join(table, F.col(col) == F.col("__k"), "left").withColumn(
        name or col, F.coalesce("__v", col)
    ).drop("__k", "__v")


def lookup_inner(df: DataFrame, col: str, dim: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """``col`` translated by ``dim``, unknown values dropped."""
    table = one_per_key(dim, key, value, order).withColumnsRenamed({key: "__k", value: "__v"})
    return df.join(table, F.col(col) == F.col("__k")).withColumn(name, F.col("__v")).drop("__k", "__v")


def neighbour_pairs(df: DataFrame, group: list[str], order: list[str], item: str, parts: int | None = None) -> DataFrame:
    """Each item with the one before it in its group: as many pairs as items, less one per group.

    All unordered pairs of a group grow with its square. Jobs that ask for a phrase between two items name the pairs by
    the phrase (``relations.pattern_relations``), others list the pairs they want (``listed_pairs``).
    """
    scan = OrderedScan(df.where(F.col(item).isNotNull()), group, order, parts).previous(item, "left_item")
    return scan.result().where(F.col("left_item").isNotNull()).withColumnRenamed(item, "right_item")


def pair_count(df: DataFrame, group: list[str]) -> DataFrame:
    """Items of each group and the number of unordered pairs among them, by formula."""
    n = F.count(F.lit(1))
    return df.groupBy(*group).agg(n.alias("items"), (n * (n - 1) / 2).cast("long").alias("pairs"))


def listed_pairs(members: DataFrame, group: str, item: str, wanted: DataFrame) -> DataFrame:
    """Groups in which both ends of a ``wanted(left_item, right_item)`` pair occur.

    Two equi-joins on the wanted pairs: the pairs of a group are never enumerated.
    """
    seen = members.select(F.col(group).alias("__g"), F.col(item).alias("__i")).distinct()
    left = wanted.join(seen, F.col("left_item") == F.col("__i")).drop("__i")
    return left.join(
        seen.withColumnsRenamed({"__g": "__g2", "__i": "__i2"}),
        (F.col("right_item") == F.col("__i2")) & (F.col("__g") == F.col("__g2")),
    ).select(F.col("__g").alias(group), *wanted.columns)


def first_rule(text: Column, rules: list[tuple[str, str]], asks: Callable[[Column, str], Column] | None = None) -> Column:
    """Result of the first rule ``(pattern, result)`` whose pattern occurs, null if none does.

    Rules are a short ordered list, so they become one CASE expression: no join, no shuffle. ``asks`` gives a cheaper
    condition that holds wherever a pattern occurs; the pattern is tried only there.
    """
    fits = lambda pattern: asks(text, pattern) & text.rlike(pattern) if asks else text.rlike(pattern)
    first, *rest = rules
    return reduce(lambda c, r: c.when(fits(r[0]), r[1]), rest, F.when(fits(first[0]), first[1]))


def with_grid(df: DataFrame, name: str, values: list) -> DataFrame:
    """Every row once per grid value. The grid is a short literal list: a generator, not a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
