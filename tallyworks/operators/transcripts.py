"""Speech transcripts: words, speaker runs, text windows and label scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import chunk_count, even_slices, joined, seconds, words
from tallyworks.operators.aggs import concat_by
from tallyworks.operators.scan import OrderedScan
from tallyworks.operators.windows import even_parts, part_of, runs

# Shape of a transcript file.
TRANSCRIPT_DDL = (
    "results array<struct<alternatives: array<struct<words: array<struct<"
    "startTime: string, endTime: string, word: string, speakerTag: int>>>>>>"
)


def transcript_of(text: Column, start: Column) -> Column:
    """``results`` as a speech service would return them for a text; half a second per word."""
    items = F.transform(
        words(text),
        lambda w, i: F.struct(
            F.concat((start * 1000 + i * 0.5).cast("string"), F.lit("s")).alias("startTime"),
            F.concat((start * 1000 + i * 0.5 + 0.4).cast("string"), F.lit("s")).alias("endTime"),
            w.alias("word"),
            # speakers take turns inside a text: the tag changes where a word ends a sentence
            (F.length(w) % 3).cast("int").alias("speakerTag"),
        ),
    )
    partial = F.array(F.struct(F.slice(items, 1, 1).alias("words")))
    whole = F.array(F.struct(items.alias("words")))
    return F.array(F.struct(partial.alias("alternatives")), F.struct(whole.alias("alternatives")))


def words_from_transcript(df: DataFrame, keys: list[str], results: str = "results") -> DataFrame:
    """Words of the first alternative of the last result, with position and duration in seconds."""
    last = F.try_element_at(F.col(results), F.lit(-1))
    best = F.try_element_at(last["alternatives"], F.lit(1))
    rows = df.select(*keys, F.posexplode(best["words"]).alias("pos", "w"))
    return rows.select(
        *keys,
        "pos",
        F.col("w.word").alias("word"),
        F.col("w.speakerTag").alias("speaker"),
        (seconds(F.col("w.endTime")) - seconds(F.col("w.startTime"))).alias("duration"),
    )


def word_table(df: DataFrame, file: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Words with the number of the speaker's uninterrupted part, counted within each file."""
    return runs(df, file, order, "speaker", "part", parts)


def speaker_runs(word_rows: DataFrame, file: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Text, speaker, time and word count of every uninterrupted part."""
    numbers = {"speaker": F.min("speaker"), "time": F.sum("duration"), "count": F.count(F.lit(1))}
    return concat_by(word_rows, [*file, "part"], "word", order, " ", "content", numbers, parts)


def speaker_totals(word_rows: DataFrame, file: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """All words, time and word count of every speaker of a file."""
    numbers = {"time": F.sum("duration"), "count": F.count(F.lit(1))}
    return concat_by(word_rows, [*file, "speaker"], "word", order, " ", "content", numbers, parts)


def text_windows(df: DataFrame, keys: list[str], text: str, n: int = 30) -> DataFrame:
    """Each text cut into ``n`` windows of nearly equal word count, numbered from 1.

    A text shorter than ``n`` words has empty windows at its end. Works inside the row: no shuffle.
    """
    split = df.select(*keys, words(F.col(text)).alias("__w"))
    return split.select(
        *keys, F.posexplode(joined(even_slices(F.col("__w"), F.lit(n)))).alias("__i", "content")
    ).select(*keys, (F.col("__i") + 1).alias("window"), "content")


def text_chunks(df: DataFrame, keys: list[str], text: str, size: int = 512) -> DataFrame:
    """Texts longer than ``size`` characters in ceil(length / size) parts of nearly equal word count.

    Words are divided evenly, so a part can exceed the size. Shorter texts stay as they are.
    """
    split = df.select(
        *keys, F.col(text).alias("__t"), words(F.col(text)).alias("__w"), chunk_count(F.col(text), size).alias("__k")
    )
    parts = F.when(F.col("__k") > 1, joined(even_slices(F.col("__w"), F.greatest("__k", F.lit(1))))).otherwise(
        F.array("__t")
    )
    return split.select(*keys, F.posexplode(parts).alias("__i", "content")).select(
        *keys, (F.col("__i") + 1).alias("chunk"), "content"
    )


def word_windows(word_rows: DataFrame, keys: list[str], order: list[str], n: int = 30, parts: int | None = None) -> DataFrame:
    """Words with their ``window`` 1..n of all words of the key, cut as by ``text_windows``.

    For texts that come as word rows: they are never put into one cell.
    """
    return even_parts(word_rows, keys, order, F.lit(n), "window", parts)


def word_chunks(
    word_rows: DataFrame, keys: list[str], order: list[str], word: str = "word", size: int = 512, parts: int | None = None
) -> DataFrame:
    """Chunks ``(keys, chunk, content)`` of the words of each key, cut as by ``text_chunks``.

    The number of chunks follows from the length that the joined text would have. Only a chunk's own
    words meet in one task, however many words a key has.
    """
    scan = OrderedScan(word_rows, keys, order, parts)
    length = F.col("__chars") + F.col("__n") - 1
    scan.group_sum(F.length(word).cast("long"), "__chars").group_sum(F.lit(1).cast("long"), "__n").row_number("__i")
    k = F.greatest(F.ceil(length / F.lit(size)), F.lit(1))
    rows = scan.result().withColumn("chunk", part_of("__i", "__n", k))
    return concat_by(rows, [*keys, "chunk"], word, order, " ", "content", parts=parts)


def lexicon_scores(chunks: DataFrame, keys: list[str], lexicon: DataFrame, labels: list[str], text: str = "content") -> DataFrame:
    """Share of each label's weight among the weights of the chunk's words, one column per label.

    ``lexicon(word, label, weight)`` stands for the model. While it is small enough to be broadcast,
    words are looked up and summed in the task that read their chunk and only sums travel. A chunk
    without a listed word scores 0 everywhere.
    """
    tokens = chunks.select(*keys, F.explode_outer(words(F.lower(F.col(text)))).alias("word"))
    hits = tokens.join(lexicon, "word", "left")
    weight = F.col("weight")
    total = F.sum(weight)
    cols = [
        F.coalesce(F.try_divide(F.sum(F.when(F.col("label") == v, weight)), total), F.lit(0.0)).alias(v) for v in labels
    ]
    return hits.groupBy(*keys).agg(*cols)


def mean_scores(scores: DataFrame, keys: list[str], labels: list[str], prefix: str = "") -> DataFrame:
    return scores.groupBy(*keys).agg(*[F.avg(v).alias(prefix + v) for v in labels])
