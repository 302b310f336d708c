"""Column expressions on text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.functions.fixed_values import (
    OBJECT_MARK,
    RELATION_MARK,
    SEQUENCE_MARKS,
    TRIPLE_MARK,
)


def capitalise(text: Column) -> Column:
    """First letter up, all others down."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2_000_000_000)))


def starts_with_pattern(text: Column, pattern: str) -> Column:
    return text.rlike(f"^(?:{pattern})")


def contains_all(text: Column, words: list[str]) -> Column:
    """All patterns occur, in any order. One search each: look-aheads would go over the rest of the
    text from every position of it."""
    return reduce(lambda a, b: a & b, [text.rlike(w) for w in words])


def line_anchored(pattern: str) -> str:
    """The same pattern, tried at line starts only where it begins with ``(?=.*``: what such a
    look-ahead finds from any place of a line it finds from the start of that line."""
    return f"(?m)^{pattern}" if pattern.startswith("(?=.*") else pattern


def seconds(text: Column) -> Column:
    """"1.5s" as 1.5; null where the text is no number with a unit."""
    return F.substring(text, F.lit(1), F.length(text) - 1).try_cast("double")


def words(text: Column) -> Column:
    """Pieces between white space, none of them empty."""
    return F.array_remove(F.split(text, r"\s+"), "")


def one_line(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def strip_markup(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]*>", "")


def decode_entities(text: Column) -> Column:
    """Named entities of the page tables; the ampersand last, so that nothing is decoded twice.

    As browsers do, the names count without their semicolon too.
    """
    pairs = [
        ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "'"), ("&nbsp;?", "\u00a0"),
        ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&"),
    ]
    return reduce(lambda t, p: F.regexp_replace(t, p[0], p[1]), pairs, text)


def stem_place(word: Column) -> Column:
    """Lower case without the plural ending (sses to ss, ies to i, s dropped but not from ss)."""
    return F.regexp_replace(F.regexp_replace(F.lower(word), "(ss|i)es$", "$1"), "([^s])s$", "$1")


def mark_terms(text: Column, terms: Column, mark: str) -> Column:
    """Every literal occurrence of every item of the array ``terms`` replaced by ``mark``."""
    return F.aggregate(terms, text, lambda t, term: F.replace(t, term, F.lit(mark)))


def first_position(text: Column, term: Column) -> Column:
    """Place of the first occurrence, letter case ignored; 0 where the term is absent."""
    return F.position(F.lower(term), F.lower(text))


def sentences(text: Column) -> Column:
    """Parts that end with ``.``, ``!`` or ``?`` and white space; the marks stay."""
    return F.array_remove(F.split(text, r"(?<=[.!?])\s+"), "")


def even_slices(items: Column, k: Column) -> Column:
    """An array cut into k arrays of nearly equal length, the longer ones first."""
    short = F.floor(F.size(items) / k).cast("int")
    longer = (F.size(items) % k).cast("int")
    return F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.slice(items, i * short + F.least(i, longer) + 1, short + (i < longer).cast("int")),
    )


def joined(slices: Column) -> Column:
    """Each inner array of words as one text."""
    return F.transform(slices, lambda s: F.array_join(s, " "))


def chunk_count(text: Column, size: int) -> Column:
    return F.ceil(F.length(text) / F.lit(size)).cast("int")


def tagged_triples(text: Column) -> Column:
    """Triples (head, type, tail) written by a generator as
    ``<triplet> head <subj> tail <obj> type <subj> tail <obj> type <triplet> ...``.

    A tail without type takes the type before it in its block. The last tail of a text may be cut
    off: it counts only when all three parts are there.
    """
    plain = reduce(lambda t, m: F.replace(t, F.lit(m), F.lit("")), SEQUENCE_MARKS, text)
    blocks = F.split(plain, TRIPLE_MARK)

    def clean(part: Column) -> Column:
        return F.array_join(words(part), " ")

    def triples_of(block: Column, b: Column) -> Column:
        parts = F.split(block, OBJECT_MARK)
        head = F.when(b > 0, clean(parts[0])).otherwise("")
        last_block = b == F.size(blocks) - 1

        def step(found: Column, part: Column) -> Column:
            pieces = F.split(part, RELATION_MARK)
            carried = F.when(F.size(found) > 0, F.element_at(found, -1)["type"]).otherwise("")
            kind = F.when(F.size(pieces) > 1, clean(F.element_at(pieces, -1))).otherwise(carried)
            row = F.struct(head.alias("head"), kind.alias("type"), clean(pieces[0]).alias("tail"))
            return F.concat(found, F.array(row))

        none = F.from_json(F.lit("[]"), "array<struct<head:string,type:string,tail:string>>")
        rows = F.aggregate(F.slice(parts, 2, F.size(parts)), none, step)
        whole = lambda r, i: (r["type"] != "") & (
            ~(last_block & (i == F.size(rows) - 1)) | ((r["head"] != "") & (r["tail"] != ""))
        )
        return F.filter(rows, whole)

    return F.flatten(F.transform(blocks, triples_of))
