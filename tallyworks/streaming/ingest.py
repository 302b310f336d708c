"""Incremental ingest: every item once, whatever is dropped again or run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyworks.sources.tables import append, append_new, unseen, written


def _stream(
    spark: SparkSession, source: str, schema: T.StructType, checkpoint: str, batch: Callable, file_format: str
) -> StreamingQuery:
    items = spark.readStream.schema(schema).format(file_format).load(source)
    return (
        items.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    spark: SparkSession, source: str, schema: T.StructType, target: str, key: str, order: list[str], checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, file_format: str = "parquet",
) -> StreamingQuery:
    """Appends new files' items to ``target``, each key once, and stops when none are left.

    The checkpoint remembers the files. A batch that runs again after a failure finds its keys in
    the target and adds nothing, so the target is right whenever the job was interrupted. The keys
    seen are the target's own column, read once per batch: no state grows in the stream.
    """

    def batch(df: DataFrame, _: int) -> None:
        append_new(prepare(df), target, key, order)

    return _stream(spark, source, schema, checkpoint, batch, file_format)


def append_parts(rows: DataFrame, target: str, key: str) -> None:
    """Appends all rows of keys that ``target`` does not hold yet; one write holds a key's rows."""
    known = written(rows.sparkSession, target)
    append(rows if known is None else rows.join(known.select(key).distinct(), key, "left_anti"), target)


def fan_out_stream(
    spark: SparkSession, source: str, schema: T.StructType, main: tuple[str, Callable[[DataFrame], DataFrame]],
    parts: dict[str, Callable[[DataFrame], DataFrame]], key: str, order: list[str], checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, file_format: str = "parquet",
) -> StreamingQuery:
    """One batch written to a main table and then to tables derived from its items.

    ``prepare`` gives a batch its ``key``. ``main`` is (target, rows of items), ``parts`` maps each further
    target to its rows; the main table keeps ``key`` and ``order``. A batch is reduced to one item per key
    first (the first by ``order``), and parts are written only of items that are the main table's own, so
    a dropped copy leaves nothing anywhere. Every write leaves out the keys its target holds, so a batch
    that stopped between two writes is completed by its next run.
    """

    def batch(df: DataFrame, _: int) -> None:
        items = unseen(prepare(df), None, key, order).persist()
        try:
            append_new(main[1](items), main[0], key, order)
            own = written(items.sparkSession, main[0])
            kept = items.join(own.select(key, *order).distinct(), [key, *order], "left_semi") if own is not None else items
            for target, rows in parts.items():
                append_parts(rows(kept), target, key)
        finally:
            items.unpersist()

    return _stream(spark, source, schema, checkpoint, batch, file_format)
