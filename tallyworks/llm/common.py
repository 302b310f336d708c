"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.session import new_folder

# white space of the word contract, as characters for trim and as a pattern for split
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
# between two words of a shingle: anything but letters, digits and marks
NOT_WORD = "[^\\p{L}\\p{N}\\p{M}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table in the shared folder and read back.

    The lineage ends there, executors may be lost afterwards, and the planner knows the real size: a
    join with the table is a broadcast only below Spark's own threshold.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def plain_words(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def folded_words(text: Column) -> Column:
    """Lower-case words of letters, digits and marks, as shingles use them."""
    cleaned = F.btrim(F.regexp_replace(F.lower(text), NOT_WORD, " "))
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.split(cleaned, " "))


def text_hash(text: str) -> Column:
    """64 bits of a text; with the id it names a row, so that repeated ids with other texts stay apart."""
    return F.xxhash64(F.col(text))


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of the named columns in which two nulls are equal; Spark still joins by hash or sort."""
    cond = F.lit(True)
    for name in columns:
        cond = cond & left[name].eqNullSafe(right[name])
    return cond
