"""The corpus pipeline: documents through quality rules, cross-site lines, near copies, test items and the mixture.

The concentration steps of the first stage have no SQL, so neither has the whole; tests/llm/test_pipeline.py runs all
stages against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import dart_minhash, decontaminate, line_spread, mixing, robust_quality
from tallyworks.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or their distance rejects go."""
    return robust_quality.without_outliers(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of five sites and more go; the count of characters follows the text."""
    cleaned = line_spread.without_spread_lines(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return dart_minhash.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The draws of the mixed stream: ``doc_id, source, pass, block, place, tokens``."""
    return mixing.mixed_blocks(docs).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
