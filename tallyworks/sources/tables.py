"""Tables in and out: named tables, JDBC, appends that know their keys."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A named table or view; filters put on the result reach its scan."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 64,
    **options: str,
) -> DataFrame:
    """A database table; with ``split_column`` and ``bounds`` it is read over many connections."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_column and bounds:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts
        )
    return reader.load()


def append(df: DataFrame, target: str) -> None:
    """Adds rows to a parquet folder."""
    df.write.mode("append").parquet(target)


def append_table(df: DataFrame, table: str) -> None:
    """Adds rows to a catalog table, made on first use."""
    df.write.mode("append").saveAsTable(table)


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Adds rows to a database table, one connection per partition."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def written(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of a parquet folder, None where it has not been written yet."""
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def unseen(df: DataFrame, known: DataFrame | None, key: str, order: list[str]) -> DataFrame:
    """One row per key (the first by ``order``), keys that ``known`` holds left out.

    The anti-join runs once per batch. Rows are reduced to one per key before they meet the known
    keys, so a key with many copies is merged on the map side and does not travel.
    """
    rest = [c for c in df.columns if c != key]
    one = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    ).select(key, "__row.*").select(*df.columns)
    return one if known is None else one.join(known.select(key), key, "left_anti")


def append_new(df: DataFrame, target: str, key: str, order: list[str]) -> None:
    """Appends the rows whose key the target does not hold yet, each key once."""
    append(unseen(df, written(df.sparkSession, target), key, order), target)


def to_sink_schema(df: DataFrame, mapping: dict[str, str], drop: list[str] = ()) -> DataFrame:
    """Column names of the target; free-text columns that it does not keep are dropped."""
    return df.drop(*drop).withColumnsRenamed(mapping)
