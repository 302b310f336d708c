"""Files in and out: CSV, JSON trees, folders of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.fixed_values import NULL_TOKENS


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    null_tokens: list[str] = NULL_TOKENS,
) -> DataFrame:
    """CSV with declared columns; any of ``null_tokens`` is a missing value.

    Columns are read as text and cast afterwards, because the reader itself knows one null token
    only. Values that do not fit their type become null.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = spark.read.schema(raw).option("header", header).option("enforceSchema", True).csv(path)
    return rows.select(
        *[
            F.when(~F.col(f.name).isin(null_tokens), F.col(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV file per partition, each with a header; the key is an ordinary column."""
    df.write.mode(mode).option("header", True).csv(path)


def read_json_tree(spark: SparkSession, root: str, schema: T.StructType, glob: str = "*.json") -> DataFrame:
    """All files below ``root`` whose name fits ``glob``, read as one table with a declared schema."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .json(root)
    )


def load_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every parquet table below ``folder`` by name; a table is one file or a folder of parts.

    Only file names are listed, file contents are not touched. The driver keeps one name per table.
    """
    root = folder.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(root)
    )
    entry = F.regexp_extract(F.substring_index("path", f"{root}/", -1), r"^([^/]+)", 1)
    names = [r["entry"] for r in files.select(entry.alias("entry")).distinct().orderBy("entry").collect()]
    return {name.removesuffix(".parquet"): spark.read.parquet(f"{root}/{name}") for name in names}


def load_database(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """Every table and view of a catalog database by name."""
    listed = spark.catalog.listTables(database)
    return {t.name: spark.table(".".join([*(t.namespace or []), t.name])) for t in listed}


def file_stem(path: Column) -> Column:
    """File name without folders and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def with_file_key(df: DataFrame, name: str = "file_key") -> DataFrame:
    """Adds the stem of the file that each row was read from."""
    return df.withColumn(name, file_stem(F.col("_metadata.file_path")))
