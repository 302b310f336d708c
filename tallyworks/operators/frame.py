"""Columns, filters, recoding and stacking of tables."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "number": T.NumericType,
    "string": T.StringType,
    "boolean": T.BooleanType,
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the named columns; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def columns_of(df: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> list[str]:
    """Column names by kind of type: number, string, boolean, date."""

    def fits(field: T.StructField, kinds: list[str]) -> bool:
        return any(isinstance(field.dataType, _KINDS[k]) for k in kinds)

    return [
        f.name
        for f in df.schema.fields
        if (not include or fits(f, include)) and not (exclude and fits(f, exclude))
    ]


def not_equal_keep_null(col: Column, value) -> Column:
    """Differs from ``value``, where a missing value differs too."""
    return ~col.eqNullSafe(F.lit(value))


def same(a: Column, b: Column) -> Column:
    """Equality that is false, not null, when a side is missing."""
    return F.coalesce(a == b, F.lit(False))


def bin_by(col: Column, edges: list, labels: list[str], missing: str = "0") -> Column:
    """Label of the right-closed interval of a value; ``missing`` for null.

    One more label than edges: the last one is for values above the last edge.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("bin_by needs one label more than edges")
    steps = reduce(lambda c, e: c.when(col <= e[0], e[1]), zip(edges, labels), F.when(col.isNull(), missing))
    return steps.otherwise(labels[-1])


def recode(col: Column, mapping: dict, keep_unknown: bool = True) -> Column:
    """Value by dictionary; an unknown one stays (as the mapped type) or becomes null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, col)
    return F.coalesce(found, col) if keep_unknown else found


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Missing values of each named column replaced by its constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def distinct_codes(df: DataFrame, col: str, limit: int = 1000) -> list:
    """Sorted non-null codes of a column for use as column names; an error beyond ``limit``."""
    found = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{col} has more than {limit} codes; they cannot become columns")
    return sorted(found)


def indicators(df: DataFrame, col: str, values: list | None = None, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per code; fixed ``values`` save the scan that finds them."""
    prefix = col if prefix is None else prefix
    values = distinct_codes(df, col) if values is None else values
    return df.withColumns({f"{prefix}_{v}": F.coalesce(F.col(col) == v, F.lit(False)).cast("int") for v in values})


def row_sum(columns: list[Column]) -> Column:
    """Sum across columns, missing values skipped."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in columns])


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of a given order (a distributed top-n)."""
    return df.orderBy(*order).limit(n)


def order_by_list(df: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """Rows in the order of ``labels``, unknown labels last."""
    place = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(col))
    return df.orderBy(F.when(place > 0, place).otherwise(len(labels) + 1), col)


def stack(top: DataFrame, bottom: DataFrame) -> DataFrame:
    """Rows of both tables by column name; a column that one lacks is null there."""
    return top.unionByName(bottom, allowMissingColumns=True)


def profile(df: DataFrame) -> DataFrame:
    """Per column: position, type, rows, non-null values. One aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("__rows").alias("rows"),
            F.col(f.name).alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def expect_empty(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row: the number of rows that should not exist and whether there are none."""
    return df.agg(F.count(F.lit(1)).alias(name)).withColumn("ok", F.col(name) == 0)
