"""Ordered columns within groups. All of them accept groups of any size, see ``scan``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.aggs import concat_by
from tallyworks.operators.quantiles import long_values
from tallyworks.operators.scan import OrderedScan
from tallyworks.session import cut_lineage


def previous(df: DataFrame, keys: list[str], order: list[str], col: str, name: str, parts: int | None = None) -> DataFrame:
    return OrderedScan(df, keys, order, parts).previous(col, name).result()


def _flagged(scan: OrderedScan, col: str, name: str) -> OrderedScan:
    # the value in a struct: nothing before is null, a null before is a struct with a null
    scan.df = scan.df.withColumn("__here", F.struct(F.col(col).alias("v")))
    scan.previous("__here", "__before")
    same = F.col("__before").isNotNull() & F.col("__here.v").eqNullSafe(F.col("__before.v"))
    scan.df = scan.df.withColumn(name, F.when(same, 0).otherwise(1)).drop("__before", "__here")
    return scan


def change_flag(df: DataFrame, keys: list[str], order: list[str], col: str, name: str = "changed", parts: int | None = None) -> DataFrame:
    """1 on the first row and wherever the value differs from the row before, else 0.

    A null differs from any value and equals a null.
    """
    return _flagged(OrderedScan(df, keys, order, parts), col, name).result()


def runs(df: DataFrame, keys: list[str], order: list[str], col: str, name: str = "run", parts: int | None = None) -> DataFrame:
    """Number of the run of equal values that a row belongs to, from 1."""
    scan = _flagged(OrderedScan(df, keys, order, parts), col, "__flag")
    scan.running_sum("__flag", name)
    return scan.result().drop("__flag")


def run_starts(df: DataFrame, keys: list[str], order: list[str], flag: str, name: str = "starts", parts: int | None = None) -> DataFrame:
    """True where a flag holds and did not hold on the row before; the first row counts as a start."""
    rows = OrderedScan(df, keys, order, parts).previous(flag, "__before").result()
    return rows.withColumn(name, F.coalesce(F.col(flag), F.lit(False)) & ~F.coalesce("__before", F.lit(False))).drop("__before")


def cum_sum(df: DataFrame, keys: list[str], order: list[str], col: str | Column, name: str, parts: int | None = None) -> DataFrame:
    return OrderedScan(df, keys, order, parts).running_sum(col, name).result()


def running_mean(
    df: DataFrame, keys: list[str], order: list[str], col: str, inclusive: bool = True, parts: int | None = None
) -> DataFrame:
    """Adds ``seen`` and ``mean_so_far`` over the rows up to this one, or up to the one before."""
    scan = OrderedScan(df, keys, order, parts)
    scan.running_sum(F.when(F.col(col).isNotNull(), 1).otherwise(0).cast("long"), "seen", inclusive)
    scan.running_sum(F.col(col), "__sum", inclusive)
    return scan.result().withColumn("mean_so_far", F.try_divide("__sum", "seen")).drop("__sum")


def fill_back(df: DataFrame, keys: list[str], order: list[str], col: str, name: str, parts: int | None = None) -> DataFrame:
    """Missing values take the next known one of their group; those behind the last stay missing."""
    return OrderedScan(df, keys, order, parts).next_non_null(col, name).result()


def part_of(position: str, size: str, k: Column) -> Column:
    """Part 1..k of the position (from 1) in an ordered group, the longer parts first."""
    i, short, longer = F.col(position) - 1, F.floor(F.col(size) / k), F.col(size) % k
    in_longer = F.floor(i / (short + 1))
    # with fewer rows than parts every row is in a longer one
    in_shorter = longer + F.floor((i - longer * (short + 1)) / F.greatest(short, F.lit(1)))
    return (F.when(i < longer * (short + 1), in_longer).otherwise(in_shorter) + 1).cast("int")


def even_parts(df: DataFrame, keys: list[str], order: list[str], k: Column, name: str = "part", parts: int | None = None) -> DataFrame:
    """Part 1..k of an ordered group cut into k nearly equal parts, the longer ones first.

    ``k`` may differ from group to group.
    """
    scan = OrderedScan(df, keys, order, parts).row_number("__i").with_group_size("__n")
    return scan.result().withColumn(name, part_of("__i", "__n", k)).drop("__i", "__n")


def merge_adjacent(
    df: DataFrame, keys: list[str], position: str, text: str, mark: str | None = None, name: str = "term",
    parts: int | None = None,
) -> DataFrame:
    """Items on consecutive positions joined into one, with ``mark`` turned into a blank.

    The separator is empty: word pieces carry their own mark at a word start.
    """
    scan = OrderedScan(df, keys, [position], parts).row_number("__rn")
    rows = scan.result().withColumn("__island", F.col(position) - F.col("__rn"))
    out = concat_by(
        rows, [*keys, "__island"], text, [position], "", name, {"start": F.min(position)}, parts
    ).drop("__island")
    cleaned = F.trim(F.replace(F.col(name), F.lit(mark), F.lit(" "))) if mark else F.trim(name)
    return out.withColumn(name, cleaned)


def rank_scale(fit_on: DataFrame, apply_to: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """Empirical rank of each value among the distinct values of its column, scaled to 0..1.

    Rows (column, value, scaled) of the distinct values of ``apply_to``; a value that was not
    fitted is left out. See ``learn.prep.QuantileScaler`` for values in between.
    """
    distinct = cut_lineage(long_values(fit_on, columns).where(F.col("value").isNotNull()).distinct())
    ranked = OrderedScan(distinct, ["column"], ["value"], parts).row_number("__r").with_group_size("__n").result()
    scaled = ranked.select(
        "column", "value", F.when(F.col("__n") == 1, 0.0).otherwise((F.col("__r") - 1) / (F.col("__n") - 1)).alias("scaled")
    )
    if apply_to is fit_on:
        return scaled
    return long_values(apply_to, columns).distinct().join(scaled, ["column", "value"])
