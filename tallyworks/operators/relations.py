"""Sentences, mentions of terms, and relations between them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.fixed_values import IS_A_RULES
from tallyworks.functions.text import sentences, tagged_triples
from tallyworks.operators.joins import first_rule


def sentence_table(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per sentence with its place in the text, from 0."""
    return df.select(*keys, F.posexplode(sentences(F.col(text))).alias("sentence_no", "sentence"))


def tokens(text):
    """Lower-case words of letters."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def mentions(sentence_rows: DataFrame, keys: list[str], terms: DataFrame, longest: int = 1) -> DataFrame:
    """Places of dictionary terms in sentences.

    ``terms(term)`` holds distinct lower-case terms of up to ``longest`` words. Word sequences are
    matched by an equi-join on the term, so the cost grows with the text and not with text times
    dictionary.
    """
    split = sentence_rows.select(*keys, tokens(F.col("sentence")).alias("__w"))

    def grams_of(n: int) -> DataFrame:
        places = F.sequence(F.lit(1), F.size("__w") - (n - 1))
        grams = F.transform(places, lambda i: F.array_join(F.slice("__w", i, n), " "))
        return split.where(F.size("__w") >= n).select(*keys, F.posexplode(grams).alias("pos", "term"))

    out = split.select(*keys, F.posexplode("__w").alias("pos", "term"))
    for n in range(2, longest + 1):
        out = out.unionByName(grams_of(n))
    return out.join(terms.select("term"), "term").select(*keys, "pos", "term")


SLOT = r"NP_\\w\+|NP__"


def between_slots(pattern: str) -> str:
    """What a rule asks for between its first two marks, as a pattern of its own.

    A repeated mark counts once, so brackets that the cut opened or left open go.
    """
    inside = re.split(SLOT, pattern)[1]
    keep, open_at = [], []
    for part in re.findall(r"\\.|\)[+*?]?|.", inside):
        keep.append(part)
        if part == "(":
            open_at.append(len(keep) - 1)
        elif part[0] == ")":
            if open_at:
                open_at.pop()
            else:
                keep.pop()
    for at in open_at:
        keep[at] = ""
    found = "".join(keep)
    # its matches are no longer than the pattern itself
    if re.search(r"[+*{]", found.replace("\\+", "").replace("\\*", "")):
        raise ValueError(f"the phrase of a rule must not repeat anything: {found}")
    return found


def fixed_words(pattern: str) -> list[str]:
    """Letters and blanks that every text in which the rule fits holds."""
    bare = re.sub(r"\([^()]*\)", "|", re.sub(r"\([^()]*\)[?*]", "|", re.sub(SLOT, "|", pattern)))
    return re.findall(r"(?<!\\)[a-z](?:[a-z ]*[a-z])?(?![?*])", bare)


def _holds_words(text: Column, pattern: str) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(w)) for w in fixed_words(pattern)], F.lit(True))


# letters and a few more signs of words: a term of letters stands within one such run
LETTERS = r"[^\W\d_]++"


def _bare(pattern: str) -> bool:
    """Whether a rule is a mark, a phrase and a mark, the phrase between blanks, so that the words around the phrase decide."""
    phrase = between_slots(pattern)
    plain = pattern == f"NP__{phrase}NP__" and "(?" not in phrase and "|" not in re.sub(r"\([^()]*\)", "", phrase)
    return plain and phrase.endswith(" ") and bool(re.match(r"(,\??)? ", phrase))


def _terms_at(word: str, front: bool, terms: tuple[str, ...], known: dict[str, int]) -> list[str]:
    """Terms that a word begins or ends with."""
    if len(terms) > 40 + len(word):
        parts = [word[:n] if front else word[-n:] for n in range(1, len(word) + 1)]
        return [part for part in parts if part in known]
    if not (word.startswith(terms) if front else word.endswith(terms)):
        return []
    return [t for t in terms if (word.startswith(t) if front else word.endswith(t))]


def _candidates(rules: list[tuple[str, str]]):
    """Rows that end in a sentence and its terms -> the same rows, per pair that a rule's phrase brings together, with the part of the sentence that decides in place of both.

    That part is the whole sentence, or for bare rules each phrase with the run of letters before and behind it: terms of
    letters end where a run does, so marking the part gives the same as marking the sentence and cutting it then.
    """
    tried = []
    for rule, _ in rules:
        phrase, words = between_slots(rule), sorted(fixed_words(rule), key=len)
        around = re.compile(f"({LETTERS})(?=({phrase})({LETTERS}))") if _bare(rule) else None
        tried.append((words[-1] if words else "", words, re.compile(f"(?=({phrase}))"), around))
    # longer than any phrase, so that none fits across it
    gap = "\n" * (1 + max(len(rule) for rule, _ in rules))
    word = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")

    def pairs(text: str, terms: list[str]) -> list[tuple[str, str, str]]:
        held = [rule for rule in tried if rule[0] in text and all([w in text for w in rule[1]])]
        if not held:
            return []
        found: dict[tuple[int, int], set[str]] = {}
        number = {t: i for i, t in enumerate(terms)}

        def add(i: int, j: int, part: str) -> None:
            # a term on both sides fits together with any other term
            for k in (j,) if i != j else range(len(terms)):
                if k != i:
                    found.setdefault((i, k) if i < k else (k, i), set()).add(part)

        letters, whole = all(map(str.isalpha, terms)), set()
        if letters:
            known = tuple(terms)
            for at in {at for _, _, _, around in held if around for at in around.findall(text)}:
                right = _terms_at(at[-1], True, known, number)
                left = right and _terms_at(at[0], False, known, number)
                if left:
                    # the groups of the phrase itself stand between
                    part = f"{at[0]}{at[1]}{at[-1]}"
                    for x in left:
                        for y in right:
                            add(number[x], number[y], part)
        for _, _, phrase, around in held:
            if not (around and letters):
                whole.update([m.span(1) for m in phrase.finditer(text)])
        sizes = sorted({len(t) for t in terms}) if whole else []
        for a, b in whole:
            right = [number[text[b : b + n]] for n in sizes if text[b : b + n] in number]
            if not right:
                continue
            # the left term ends within the word characters that lead to the phrase
            low = a
            while low and text[low - 1] in word:
                low -= 1
            left = {number[text[e - n : e]] for e in range(low, a + 1) for n in sizes if n <= e and text[e - n : e] in number}
            for i in left:
                for j in right:
                    add(i, j, text)
        return [(terms[i], terms[j], text if text in parts else gap.join(sorted(parts))) for (i, j), parts in found.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            places, rows = [], []
            for at, (s, t) in enumerate(zip(texts, lists)):
                made = pairs(s, t)
                places += [at] * len(made)
                rows += made
            kept = batch.select(range(batch.num_columns - 2)).take(pa.array(places, pa.int64()))
            sides = [pa.array(side, pa.string()) for side in zip(*rows)] or [pa.array([], pa.string())] * 3
            yield pa.RecordBatch.from_arrays([*kept.columns, *sides], [*kept.schema.names, "left_item", "right_item", "__s"])

    return run


def pattern_relations(
    sentence_rows: DataFrame, keys: list[str], mention_rows: DataFrame, rules: list[tuple[str, str]] = IS_A_RULES, strict: bool = True
) -> DataFrame:
    """Distinct ``(head, type, tail)`` with type "subgroup of", by the phrase between two terms.

    Of every two different terms of a sentence, both are replaced by a mark all over the sentence and the first rule
    that fits gives the direction: "first" for the general term on the left, "last" on the right; left is the term that is mentioned first.
    With ``strict`` the tail is the general term. Otherwise the direction is not looked at and the
    head is the later of the two terms in alphabetical order.

    The pairs of a sentence are not enumerated. A rule fits only where its phrase stands between two marks, and a phrase
    holds no mark, so it stands in the sentence as it is. Each occurrence of a phrase names the terms that can be the mark
    before it (one that ends in the word that leads to it) and behind it (one that begins there); only those pairs are marked and tried,
    under rules that are a mark, a phrase and a mark in the words around the phrase only, so a sentence costs its length and not its square.
    A term that stands on both sides fits together with any other term. The look-up of a pair is a small Arrow function in the tasks; marking
    and rules are columns. So terms with other terms between them, repeated terms and
    terms that are words of a phrase come out as if all pairs were tried.
    """
    lists = mention_rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("__m"))
    lists = lists.select(*keys, F.array_distinct(F.transform("__m", lambda m: m["term"])).alias("__t")).where(F.size("__t") > 1)
    rows = lists.join(sentence_rows.select(*keys, F.lower("sentence").alias("__s")), keys)
    rows = rows.select(*keys, "__s", "__t")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("__s", "__t")]
    pairs = rows.mapInArrow(_candidates(rules), ", ".join([*fields, "left_item string", "right_item string", "__s string"]))
    # the longer term first: a term inside the other one must not break it
    left_first = F.length("left_item") >= F.length("right_item")
    longer, shorter = F.when(left_first, F.col("left_item")).otherwise(F.col("right_item")), F.when(left_first, F.col("right_item")).otherwise(F.col("left_item"))
    marked = pairs.withColumn("__m", F.replace(F.replace("__s", longer, F.lit("NP__")), shorter, F.lit("NP__")))
    found = marked.withColumn("__d", first_rule(F.col("__m"), rules, _holds_words)).where(F.col("__d").isNotNull())
    left, right = F.col("left_item"), F.col("right_item")
    if strict:
        general, special = F.when(F.col("__d") == "first", left).otherwise(right), F.when(F.col("__d") == "first", right).otherwise(left)
    else:
        general, special = F.least(left, right), F.greatest(left, right)
    # a pair stands once in a sentence, so nothing repeats
    return found.select(*keys, special.alias("head"), F.lit("subgroup of").alias("type"), general.alias("tail"))


def parse_triples(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Triples of tagged generator output with their place in it; a triple of one entity with itself goes."""
    rows = df.select(*keys, F.posexplode(tagged_triples(F.col(text))).alias("ord", "__t"))
    return rows.select(*keys, "ord", "__t.*").where("head <> tail")
